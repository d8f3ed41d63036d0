"""The registered queries: (spark, sf_dir) -> DataFrame, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinestar.functions.keys import hash_key
from cinestar.functions.scalars import VOICE, role_of
from cinestar.operators import cast, changes, dense, enrich, films, increments, lookups, posters, ratings
from cinestar.operators.collections import film_id, is_malformed, parse_column
from cinestar.plans import distinct, star, vault
from cinestar.session import scratch_path
from cinestar.sources import fixtures as raw
from cinestar.sources import drift, publish, schemas, tables
from cinestar.sources.csv import export_csv, read_csv
from cinestar.sources.records import read_records

# Catalog schema of tables that live as long as the session.
SCRATCH = "cinestar_scratch"

Query = Callable[[SparkSession, str], DataFrame]


DENIED = (*films.DENIED_IMDB_IDS, *raw.DENIED)


def _movies(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Accepted rows of the metadata export, copies included."""
    return films.accept_films(raw.raw_movies(spark, sf, *columns), DENIED)


def _unique(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Accepted films, one row each: the copy is chosen by its whole row, then projected."""
    unique = films.one_per_film(films.accept_films(raw.raw_films(spark, sf), DENIED))
    return raw.with_attributes(unique, spark, sf, *columns)


def _all_unique(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """All films, denied ones as well, one row each."""
    return raw.with_attributes(
        films.one_per_film(raw.raw_films(spark, sf)), spark, sf, *columns
    )


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    return films.fact_films(films.accept_films(raw.raw_films(spark, sf), DENIED))


def _companies(spark: SparkSession, sf: str) -> DataFrame:
    return films.dim_companies(films.of_films(raw.raw_companies(spark, sf), _unique(spark, sf)))


def _totals(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.film_totals(ratings.fact_ratings(raw.raw_ratings(spark, sf)))


def _votes(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.film_votes(_facts(spark, sf), _totals(spark, sf))


def _members(spark: SparkSession, sf: str) -> DataFrame:
    return cast.cast_members(raw.raw_credits(spark, sf))


def _film_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _all_unique(spark, sf).select(film_id().alias("film_id"), "imdb_id")


def _scalar(attribute: str) -> Query:
    columns = () if attribute == "imdb_id" else (attribute,)
    return lambda spark, sf: films.scalar_dim(_unique(spark, sf, *columns), attribute)


def _characters(policy: str) -> Query:
    """Characters as the two simpler cleaning policies leave them."""
    return lambda spark, sf: cast.dim_characters(
        cast.cast_members(raw.raw_credits(spark, sf), policy)
    )


def ratings_filtered(spark: SparkSession, sf: str) -> DataFrame:
    liked = ratings.above(raw.raw_ratings(spark, sf), "rating", 2.5)
    totals = ratings.film_totals(ratings.fact_ratings(liked))
    return totals.select("film_id", "freq", "rating")


def ratings_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a damaged export that name no film or give no number."""
    return ratings.split_ratings(raw.damaged_ratings(spark, sf))[1]


def scalar_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Values of a damaged export that are not of their column's type."""
    return films.scalar_quarantine(films.one_per_film(raw.damaged_films(spark, sf)))


def ratings_unlinked(spark: SparkSession, sf: str) -> DataFrame:
    """Rated ids without a link, where only the films of up to 25 minutes have one."""
    links = raw.table(spark, sf, "part").where("p_size <= 25")
    links = links.select(F.col("p_partkey").alias("rating_id"), F.col("p_partkey").alias("film_id"))
    lost = ratings.unlinked_totals(_totals(spark, sf), links)
    return lost.select("rating_id", "freq", "rated")


def ratings_remapped(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings whose ids are those of the films' brands: many ids lead to one."""
    links = raw.table(spark, sf, "part").select(
        F.col("p_partkey").alias("rating_id"),
        F.regexp_extract("p_brand", r"(\d+)$", 1).cast("bigint").alias("film_id"),
    )
    mapped = ratings.remap_totals(_totals(spark, sf), links)
    return mapped.select("film_id", "freq", "rating")


def films_deny_table(spark: SparkSession, sf: str) -> DataFrame:
    """The deny-list as a table: the films that were ordered in bulk."""
    bulk = raw.table(spark, sf, "lineitem").where("l_quantity = 50").select("l_partkey")
    denied = bulk.select(
        F.concat(F.lit("tt"), raw.outside_id(F.col("l_partkey"))).alias("imdb_id")
    )
    accepted = films.accept_films_by_table(raw.raw_movies(spark, sf, "title"), denied)
    return accepted.select(film_id().alias("film_id"), "imdb_id", "title")


def films_denylist(spark: SparkSession, sf: str) -> DataFrame:
    return _movies(spark, sf, "title").select(film_id().alias("film_id"), "imdb_id", "title")


def json_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Credits cells, and unparsable ones among them, per film."""
    parsed = parse_column(raw.raw_credits(spark, sf), "cast", schemas.CAST_MEMBER)
    return parsed.groupBy(film_id().alias("film_id")).agg(
        F.count("*").alias("cells"), F.count_if(is_malformed("cast")).alias("malformed")
    )


def json_infer(spark: SparkSession, sf: str) -> DataFrame:
    """Countries by a schema found in the data; inference and parse read one stage."""
    cells = _unique(spark, sf, "production_countries")
    staged = tables.overwrite_parquet(cells, scratch_path(spark, "countries"))
    return films.dim_countries_inferred(staged)


def event_props(spark: SparkSession, sf: str) -> DataFrame:
    return raw.table(spark, sf, "events").select(
        "event_id", "event_type", F.from_json("props", "k int")["k"].alias("k")
    )


def conversation_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as JSON text and back; a bare object parses as a list of one."""
    cells = raw.table(spark, sf, "conversations").select(
        "conv_id", F.to_json(F.struct("turn", "role", "text")).alias("turns")
    )
    parsed = parse_column(
        cells, "turns", "turn bigint, role string, text string", "turn", policy="none"
    )
    return parsed.select("conv_id", F.explode("turn").alias("turn")).select("conv_id", "turn.*")


def _drifted_turns(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Turns as JSON cells of two exports: the second has turns as text, and the length of the text."""
    rows = raw.table(spark, sf, "conversations")
    later = F.struct(F.format_string("t%d", "turn").alias("turn"), "role", "text", F.length("text").alias("size"))
    first, second = F.struct("turn", "role", "text"), later
    return tuple(rows.select("conv_id", F.to_json(F.array(cell)).alias("turns")) for cell in (first, second))


def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of the turns that differ between two exports."""
    path = scratch_path(spark, "fields")
    for run, cells in zip("12", _drifted_turns(spark, sf), strict=True):
        drift.note_run(cells, "turns", path, run, policy="none")
    return drift.differences(spark, path, "1", "2")


def drift_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of the second export by the fields of the first: what these do not take is still there."""
    declared = {"turn": "bigint", "role": "string", "text": "string"}
    parsed = drift.parse_keeping(_drifted_turns(spark, sf)[1], "turns", declared, policy="none")
    rows = parsed.select("conv_id", F.explode("elements").alias("e"))
    rest = F.col("e.rest")
    return rows.select(
        "conv_id", "e.turn", "e.role", "e.text",
        F.try_variant_get(rest["turn"], "$", "string").alias("turn_text"),
        F.try_variant_get(rest["size"], "$", "bigint").alias("size"),
    )


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts through CSV, line breaks and quotes included."""
    path = scratch_path(spark, "csv")
    export_csv(raw.table(spark, sf, "documents").select("doc_id", "lang", "text"), path)
    rows = read_csv(spark, path, header=("doc_id", "lang", "text"), multiline=True)
    return rows.withColumn("doc_id", F.col("doc_id").try_cast("bigint"))


def csv_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts through a few large CSV files, each read by as many tasks as it has blocks."""
    path = scratch_path(spark, "csv")
    documents = raw.table(spark, sf, "documents").select("doc_id", "lang", "text")
    export_csv(documents, path, rows_per_file=0)
    rows = read_records(spark, path, ("doc_id", "lang", "text"))
    return rows.withColumn("doc_id", F.col("doc_id").try_cast("bigint"))


def csv_single_line(spark: SparkSession, sf: str) -> DataFrame:
    """Credits through the splittable scan: a printed collection holds no line break."""
    path = scratch_path(spark, "credits")
    export_csv(raw.raw_credits(spark, sf), path)
    members = cast.cast_members(read_csv(spark, path, require=schemas.CREDITS))
    return members.groupBy("film_id").agg(
        F.count("*").alias("members"),
        F.count_if(role_of(F.col("character")) == VOICE).alias("voices"),
    )


def table_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table written twice holds one run; read back by SQL."""
    path = scratch_path(spark, "table")
    name = f"{SCRATCH}.DimGenres_{path[-32:]}"
    tables.ensure_schema(spark, SCRATCH)
    genres = films.dim_genres(_unique(spark, sf, "genres"))
    for _ in range(2):
        tables.save_table(genres, name, path)
    return spark.sql(f"select * from {name.lower()}")


def parquet_stage(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "stage")
    return tables.overwrite_parquet(ratings.fact_ratings(raw.raw_ratings(spark, sf)), path)


def daily_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Two daily runs, the second one repeated: every run is there once."""
    path = scratch_path(spark, "runs")
    rows = ratings.fact_ratings(raw.raw_ratings(spark, sf))
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        tables.overwrite_run(rows, path, {"run_date": day})
    back = spark.read.schema("film_id bigint, rating double, run_date string").parquet(path)
    return back.groupBy("run_date", "rating").agg(F.count("*").alias("freq"))


def published_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A table published twice: its previous version, of the ratings up to 1995, and its current one."""
    path, rows = scratch_path(spark, "published"), raw.dated_ratings(spark, sf)
    publish.publish(rows.where("day < DATE'1996-01-01'"), path, note="up to 1995")
    publish.publish(rows, path, note="all")
    both = publish.read_versions(spark, path, publish.ledger(spark, path))
    return both.groupBy("version", "rating").agg(F.count("*").alias("freq"))


def votes_by_increments(spark: SparkSession, sf: str) -> DataFrame:
    """Votes of three runs of ratings, one of which came with wrong ratings first and was replaced."""
    path, rows = scratch_path(spark, "increments"), raw.dated_ratings(spark, sf)
    early = rows.where("day < DATE'1994-01-01'")
    middle = rows.where("day >= DATE'1994-01-01' AND day < DATE'1997-01-01'")
    late = rows.where("day >= DATE'1997-01-01' OR day IS NULL")
    wrong = middle.withColumn("rating", F.lit(5.0) - F.col("rating"))
    for run, part in (("a", early), ("b", wrong), ("c", late), ("b", middle)):
        increments.add_run(part, path, {"run": run})
    return increments.read_totals(spark, path).select("film_id", "freq", "rated", "rating")


def _film_run(spark: SparkSession, sf: str, run: int) -> DataFrame:
    return films.one_per_film(raw.film_run(spark, sf, run))


def run_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Films that are new, gone or other in the second of two exports."""
    changed = changes.changed_keys(raw.film_run(spark, sf, 1), raw.film_run(spark, sf, 2), "id")
    return changed.select(film_id().alias("film_id"), "change")


def run_genres(spark: SparkSession, sf: str) -> DataFrame:
    """The genres after the second export: those of changed films parsed, all others kept."""
    cells = [raw.with_attributes(_film_run(spark, sf, run), spark, sf, "genres") for run in (1, 2)]
    cells = [tables.overwrite_parquet(c, scratch_path(spark, "cells")) for c in cells]
    changed = changes.changed_keys(*cells, "id").withColumnRenamed("id", "film_id")
    changed = tables.overwrite_parquet(changed, scratch_path(spark, "changes"))
    before = films.dim_genres(cells[0])
    return changes.refresh(before, changed, cells[1], films.dim_genres, "film_id", "id")


# Days of the two loads of the vault.
LOADS = ("1995-01-01", "1997-01-01")


def _film_satellite(spark: SparkSession, sf: str) -> DataFrame:
    """Titles and states of films, loaded from two exports."""
    known = None
    for run, day in enumerate(LOADS, 1):
        rows = _film_run(spark, sf, run).select(F.col("id").alias("film_id"), "title", "status")
        new = vault.satellite_rows(rows, hash_key("film_id"), day, known)
        new = tables.overwrite_parquet(new, scratch_path(spark, "satellite"))
        known = new if known is None else known.unionByName(new)
    return known


def vault_states(spark: SparkSession, sf: str) -> DataFrame:
    """The films as the vault has them after each load."""
    satellite = _film_satellite(spark, sf)
    states = [vault.as_of(satellite, day).withColumn("day", F.lit(day)) for day in LOADS]
    return states[0].unionByName(states[1]).select("day", "film_id", "title", "status")


def vault_loads(spark: SparkSession, sf: str) -> DataFrame:
    """What each load inserts into the satellite, gone films included."""
    return _film_satellite(spark, sf).select(
        F.col("key").alias("film_key"), F.col("load_date").cast("string").alias("day"), "deleted", "title"
    )


def vault_links(spark: SparkSession, sf: str) -> DataFrame:
    """Films and genres linked, each pair once, with the load that brought it."""
    known = None
    for run, day in enumerate(LOADS, 1):
        cells = raw.with_attributes(_film_run(spark, sf, run), spark, sf, "genres")
        new = vault.link_rows(films.dim_genres(cells), ["film_id", "name"], day, known)
        new = tables.overwrite_parquet(new, scratch_path(spark, "links"))
        known = new if known is None else known.unionByName(new)
    return known.select("key", "film_id_key", "name_key", F.col("load_date").cast("string").alias("day"))


def vault_ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings by the title that their film had on the day of the rating."""
    events = raw.dated_ratings(spark, sf).withColumn("key", hash_key("film_id"))
    satellite = _film_satellite(spark, sf).drop("film_id")
    joined = vault.as_of_join(events, satellite, "key", "day")
    return joined.groupBy("film_id", "title").agg(F.count("*").alias("freq"))


def films_by_genre_and_country(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct films per genre and country, per genre, per country and in all."""
    unique = tables.overwrite_parquet(
        _unique(spark, sf, "genres", "production_countries"), scratch_path(spark, "films")
    )
    dims = {
        "genre": films.dim_genres(unique).withColumnRenamed("name", "genre"),
        "country": films.dim_countries(unique).withColumnRenamed("name", "country"),
    }
    ids = unique.select(F.col("id").alias("film_id"))
    return distinct.distinct_films(ids, dims, [["genre", "country"], ["genre"], ["country"], []])


def person_clashes(spark: SparkSession, sf: str) -> DataFrame:
    """Persons whose credits disagree: eight customers share the id of one person."""
    shared = F.floor(F.col("cast_member_id") / 8).cast("int")
    return cast.dim_person(_members(spark, sf).withColumn("cast_member_id", shared))


def hash_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of a dimension's rows, and the key that all rows of a film share."""
    rows = films.film_keywords(raw.raw_keywords(spark, sf))
    return rows.select(
        F.col("id").alias("row_key"), hash_key("film_id").alias("film_key"), "film_id"
    )


def dense_keys(spark: SparkSession, sf: str) -> DataFrame:
    return dense.dense_key(_facts(spark, sf).withColumnRenamed("id", "film_id"), "film_id")


def range_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Films in five equal ranges of dense ids, each cut out and written by a worker of its own."""
    ids = _film_ids(spark, sf).where(F.col("imdb_id").isNotNull())
    numbered = dense.dense_key(ids, "film_id")
    numbered = tables.overwrite_parquet(numbered, scratch_path(spark, "numbered"))
    rows, paths = numbered.count(), []
    for i in range(5):
        part = numbered.where(dense.range_slice("id", i, 5, rows)).withColumn("slice", F.lit(i))
        paths.append(scratch_path(spark, f"worker-{i}"))
        part.select("id", "film_id", "slice").write.parquet(paths[-1])
    return enrich.read_worker_outputs(spark, paths).select(
        "id", "film_id", F.col("slice").cast("bigint").alias("slice")
    )


def _film_table(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """One row per accepted film with votes and sales, saved in buckets of film_id.

    Line items are aggregated once, for ratings and sales together. The table
    stands for the model: what is read from it by film needs no shuffle.
    """
    rating = F.ceil(F.col("l_quantity") / 5) * F.lit(0.5)
    per_film = (
        raw.table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("film_id"))
        .agg(
            F.count("*").alias("freq"),
            F.count(rating).alias("rated"),
            F.sum(rating).alias("rating_sum"),
            F.avg(rating).alias("rating"),
            F.min("l_shipdate").cast("date").alias("release_date"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("revenue"),
        )
    )
    own = [name for name in raw.OWN_COLUMNS if name != "imdb_id"]
    rows = _unique(spark, sf, *dict.fromkeys([*own, *columns])).withColumnRenamed("id", "film_id")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "film_table")
    name = f"{SCRATCH}.films_{path[-32:]}"
    tables.ensure_schema(spark, SCRATCH)
    return tables.save_table(rows.join(per_film, "film_id", "left"), name, path, "film_id", buckets)


def star_films(spark: SparkSession, sf: str) -> DataFrame:
    """Films, votes and all scalar dimensions put together from the bucketed table."""
    saved = _film_table(spark, sf, "homepage", "overview")
    ids = saved.withColumnRenamed("film_id", "id")
    attributes = [name for name in schemas.SCALARS if name != "imdb_id"]
    dims = {name: films.scalar_dim(ids, name) for name in attributes}
    dims["imdb_id"] = saved.select("film_id", "imdb_id")
    facts = ids.select("id", "title", "original_title")
    return star.star_films(ratings.film_votes(facts, saved.select("film_id", "rating", "freq")), dims)


def _rollup(source: str | None, dim: Callable[[DataFrame], DataFrame], name: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        saved = _film_table(spark, sf, *([source] if source else []))
        ids = saved.withColumnRenamed("film_id", "id")
        rows = ids if source else films.of_films(raw.raw_companies(spark, sf), ids)
        measures = saved.select("film_id", "freq", "rated", "rating_sum", "revenue")
        return star.rollup_by(measures, dim(rows), name)

    return query


def poster_locations(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.lookup_posters(_film_ids(spark, sf), raw.poster_table(spark, sf))


def open_template_resolver() -> enrich.Resolver:
    """Stands in for an outside service: the location follows from the id."""
    return lambda bare: f"https://posters.example.org/{bare}.jpg"


def poster_slices_union(spark: SparkSession, sf: str) -> DataFrame:
    """Every film resolved in five parallel slices, written once and read as one table."""
    found = enrich.resolve_posters(_film_ids(spark, sf), open_template_resolver)
    written = enrich.write_slices(found, scratch_path(spark, "posters"))
    return written.select("film_id", "imdb_id", "url")


def open_shaky_resolver() -> enrich.Resolver:
    """The template resolver, out of order for the ids that end with 7."""

    def resolve(bare: str) -> str:
        if bare.endswith("7"):
            raise TimeoutError(bare)
        return open_template_resolver()(bare)

    return resolve


def lookups_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """Posters after two runs of lookups, the first of which left some films with an error."""
    path, ids = scratch_path(spark, "lookups"), _film_ids(spark, sf)
    ids = tables.overwrite_parquet(ids, scratch_path(spark, "ids"))
    settings = lookups.Lookups(chunk_films=1_000_000, retries=0)
    lookups.look_up(ids, open_shaky_resolver, path, settings, datetime(2024, 1, 1))
    found = lookups.look_up(ids, open_template_resolver, path, settings, datetime(2024, 1, 2))
    return found.select("film_id", "imdb_id", "url", "error", F.col("tries").cast("bigint").alias("tries"))


def film_posters(spark: SparkSession, sf: str) -> DataFrame:
    posters_ = enrich.lookup_posters(_film_ids(spark, sf), raw.poster_table(spark, sf))
    return enrich.place_posters(_facts(spark, sf).withColumnRenamed("id", "film_id"), posters_)


def poster_labels(spark: SparkSession, sf: str) -> DataFrame:
    located = poster_locations(spark, sf).where(F.col("url").isNotNull())
    genres = films.dim_genres(_all_unique(spark, sf, "genres"))
    return posters.poster_labels(located.select("film_id", "url"), genres)


def _genre_model(spark: SparkSession, sf: str) -> tuple[PipelineModel, DataFrame]:
    """A model of the training posters, and the labels of the others."""
    features = raw.poster_features(spark, sf)
    labels = posters.poster_labels(features, films.dim_genres(_all_unique(spark, sf, "genres")))
    labels = tables.overwrite_parquet(labels, scratch_path(spark, "labels"))
    train, test = posters.split_by_film(labels)
    return posters.train_genres(train), test


def genre_scores(spark: SparkSession, sf: str) -> DataFrame:
    model, _ = _genre_model(spark, sf)
    return posters.score_genres(model, raw.poster_features(spark, sf))


def genre_score_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of each poster's ranked genres whatever the model, per poster."""
    scores = genre_scores(spark, sf)
    later = Window.partitionBy("film_id").orderBy("rank")
    falls = F.col("probability") <= F.lag("probability", 1, 2.0).over(later)
    return (
        scores.withColumn("falls", falls)
        .groupBy("film_id")
        .agg(
            F.count_distinct("genre").alias("genres"),
            F.sum("rank").cast("bigint").alias("ranks"),
            F.round(F.sum("probability"), 6).alias("probability"),
            F.every("falls").alias("descending"),
        )
    )


def genre_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Posters of each genre in each of five folds by film."""
    genres = films.dim_genres(_all_unique(spark, sf, "genres"))
    labels = posters.poster_labels(raw.poster_features(spark, sf), genres)
    folds = posters.with_folds(labels).groupBy("fold", "genre")
    return folds.agg(F.count_distinct("film_id").alias("posters"))


def genre_holdout(spark: SparkSession, sf: str) -> DataFrame:
    """The held-out posters and, for each, how many genres of its film it was judged by."""
    model, test = _genre_model(spark, sf)
    path = scratch_path(spark, "model")
    model.write().save(path)
    held = test.select("film_id", "features").dropDuplicates(["film_id"])
    scored = posters.score_genres(PipelineModel.load(path), held)
    judged = scored.join(test.select("film_id", "genre"), ["film_id", "genre"])
    return judged.groupBy("film_id").agg(F.count("*").alias("genres"))


QUERIES: dict[str, Query] = {
    "film_votes": _votes,
    "ratings_count": lambda s, d: ratings.ratings_count(_totals(s, d)),
    "ratings_mean": lambda s, d: ratings.ratings_mean(_totals(s, d)),
    "ratings_filtered": ratings_filtered,
    "ratings_remapped": ratings_remapped,
    "ratings_unlinked": ratings_unlinked,
    "ratings_quarantine": ratings_quarantine,
    "scalar_quarantine": scalar_quarantine,
    "fact_ratings": lambda s, d: ratings.fact_ratings(raw.raw_ratings(s, d)),
    "fact_films": _facts,
    "films_denylist": films_denylist,
    "films_deny_table": films_deny_table,
    "dim_countries": lambda s, d: films.dim_countries(_unique(s, d, "production_countries")),
    "dim_genres": lambda s, d: films.dim_genres(_unique(s, d, "genres")),
    "dim_companies": _companies,
    "dim_languages": lambda s, d: films.dim_languages(_unique(s, d, "spoken_languages")),
    "film_keywords": lambda s, d: films.film_keywords(raw.raw_keywords(s, d)),
    "dim_homepages": _scalar("homepage"),
    "dim_external_id": _scalar("imdb_id"),
    "dim_overview": _scalar("overview"),
    "dim_popularity": _scalar("popularity"),
    "dim_release_date": _scalar("release_date"),
    "dim_revenue": _scalar("revenue"),
    "dim_runtime": _scalar("runtime"),
    "dim_status": _scalar("status"),
    "dim_vote_average": lambda s, d: ratings.dim_vote_average(_votes(s, d)),
    "dim_vote_count": lambda s, d: ratings.dim_vote_count(_votes(s, d)),
    "dim_cast": lambda s, d: cast.dim_cast(_members(s, d)),
    "dim_characters": lambda s, d: cast.dim_characters(_members(s, d)),
    "dim_roles": lambda s, d: cast.dim_roles(_members(s, d)),
    "dim_actors": lambda s, d: cast.dim_actors(_members(s, d)),
    "characters_strip": _characters("strip"),
    "characters_space": _characters("space"),
    "json_infer": json_infer,
    "json_quarantine": json_quarantine,
    "event_props": event_props,
    "conversation_turns": conversation_turns,
    "schema_drift": schema_drift,
    "drift_kept": drift_kept,
    "csv_roundtrip": csv_roundtrip,
    "csv_blocks": csv_blocks,
    "csv_single_line": csv_single_line,
    "table_overwrite": table_overwrite,
    "parquet_stage": parquet_stage,
    "daily_rerun": daily_rerun,
    "published_versions": published_versions,
    "votes_by_increments": votes_by_increments,
    "run_changes": run_changes,
    "run_genres": run_genres,
    "vault_states": vault_states,
    "vault_loads": vault_loads,
    "vault_links": vault_links,
    "vault_ratings": vault_ratings,
    "films_by_genre_and_country": films_by_genre_and_country,
    "dim_person": lambda s, d: cast.dim_person(_members(s, d)),
    "person_clashes": person_clashes,
    "top_films": lambda s, d: ratings.top_films(_votes(s, d), 20),
    "hash_keys": hash_keys,
    "dense_keys": dense_keys,
    "range_slices": range_slices,
    "star_films": star_films,
    "star_by_genre": _rollup("genres", films.dim_genres, "name"),
    "star_by_country": _rollup("production_countries", films.dim_countries, "name"),
    "star_by_company": _rollup(None, films.dim_companies, "company_name"),
    "star_by_language": _rollup("spoken_languages", films.dim_languages, "languages"),
    "poster_locations": poster_locations,
    "poster_slices_union": poster_slices_union,
    "lookups_resumed": lookups_resumed,
    "film_posters": film_posters,
    "poster_labels": poster_labels,
    "genre_scores": genre_scores,
    "genre_score_shapes": genre_score_shapes,
    "genre_holdout": genre_holdout,
    "genre_folds": genre_folds,
}
