"""Raw film exports derived from the test tables.

The test tables hold no films, so each `part` stands for one. The functions
return frames in the shape of the raw exports: strings only, collections as
Python literals. FIXTURES.md states the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Films 0, 3, 7 and 11 are on the deny-list.
DENIED = ("tt0000000", "tt0000003", "tt0000007", "tt0000011")

# A credits cell holds the customers of one block of this many customer keys,
# so no cell can outgrow 3 x CAST_BLOCK members, however popular a film is.
CAST_BLOCK = 2048

# A companies cell holds the suppliers of one block of this many supplier keys.
COMPANY_BLOCK = 2048

# The exporter repeats the credits rows of this brand's films, cut short.
DAMAGED_BRAND = "Brand#7"

# Of two successive exports the first lacks films of one brand, the second of
# another; of a third brand, the second one has other titles and states.
COMING_BRAND, GOING_BRAND, REISSUED_BRAND = "Brand#3", "Brand#7", "Brand#5"

# Columns of a film that come from `part` alone, in the order of the export.
OWN_COLUMNS = ("imdb_id", "title", "original_title", "popularity", "runtime", "status")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def outside_id(key: Column) -> Column:
    """At least seven digits, zero-padded."""
    text = key.cast("string")
    return F.lpad(text, F.greatest(F.lit(7), F.length(text)), F.lit("0"))


def py_text(value: Column) -> Column:
    """A string the way Python prints it: double quotes if only `'` occurs, escapes, None."""
    body = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for character, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\u00a0", "\\xa0")):
        body = F.replace(body, F.lit(character), F.lit(escape))
    single = F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), body, F.lit('"'))
    quoted = F.when(value.contains("'") & ~value.contains('"'), double).otherwise(single)
    return F.coalesce(quoted, F.lit("None"))


def py_code(value: Column) -> Column:
    """A string that needs no escapes, or None."""
    return F.coalesce(F.concat(F.lit("'"), value, F.lit("'")), F.lit("None"))


def py_dict(**fields: Column) -> Column:
    """`{'a': 1, 'b': 'x'}` from already printed values."""
    pieces = []
    for name, value in fields.items():
        pieces += [F.lit(f"{', ' if pieces else '{'}'{name}': "), value]
    return F.concat(*pieces, F.lit("}"))


def py_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def py_number(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


def genre_number(name: Column) -> Column:
    """A genre's own id, from its name."""
    return F.conv(F.substring(F.md5(name), 1, 6), 16, 10).cast("int")


def _film_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(
            F.min("l_shipdate").alias("first_ship"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("sales"),
        )
    )


def _film_suppliers(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Each film's suppliers, once each, with the supplier's columns asked for."""
    pairs = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", *columns)
    return pairs.distinct().join(suppliers, "s_suppkey")


def _with_sales(films: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return films.join(_film_sales(spark, sf_dir), "p_partkey", "left").withColumns(
        {
            "release_date": F.col("first_ship").cast("date").cast("string"),
            "revenue": F.col("sales").cast("string"),
        }
    )


def _with_homepage(films: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("p_partkey"), F.col("url").alias("homepage")
    )
    return films.join(pages, "p_partkey", "left")


def _with_document(films: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("p_partkey"), F.col("text").alias("overview"), "lang"
    )
    language = py_list(
        F.array(
            py_dict(iso_639_1=py_code(F.col("lang")), name=py_text(F.initcap(F.col("lang"))))
        )
    )
    return films.join(documents, "p_partkey", "left").withColumn(
        "spoken_languages", F.when(F.col("lang").isNull(), "[]").otherwise(language)
    )


def _with_genres(films: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("p_partkey"), "label"
    )
    own = py_dict(id=py_number(genre_number(F.col("p_type"))), name=py_text(F.col("p_type")))
    label = F.col("label")
    extra = py_dict(
        id=py_number(label + 100), name=py_text(F.concat(F.lit("g"), label.cast("string")))
    )
    return films.join(labels, "p_partkey", "left").withColumn(
        "genres",
        py_list(F.when(label.isNull(), F.array(own)).otherwise(F.array(own, extra))),
    )


def _with_countries(films: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name"
    )
    cells = (
        _film_suppliers(spark, sf_dir, "s_nationkey")
        .select("p_partkey", "s_nationkey")
        .distinct()
        .join(nations, "s_nationkey")
        .groupBy("p_partkey")
        .agg(F.sort_array(F.collect_set(F.struct("s_nationkey", "n_name"))).alias("nations"))
    )
    printed = F.transform(
        "nations",
        lambda n: py_dict(
            iso_3166_1=py_code(F.concat(F.lit("N"), n.s_nationkey.cast("string"))),
            name=py_text(n.n_name),
        ),
    )
    return films.join(cells, "p_partkey", "left").withColumn(
        "production_countries", py_list(printed)
    )


# Columns of the raw films that need more than `part`, and the join that adds them.
_JOINED = (
    (_with_sales, ("release_date", "revenue")),
    (_with_homepage, ("homepage",)),
    (_with_document, ("overview", "spoken_languages")),
    (_with_genres, ("genres",)),
    (_with_countries, ("production_countries",)),
)


def raw_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata export's id and the columns that `part` alone gives, copies included."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.when(
            F.col("p_size") < 50, F.concat(F.lit("tt"), outside_id(F.col("p_partkey")))
        ).alias("imdb_id"),
        F.col("p_name").alias("title"),
        F.concat_ws(" ", "p_brand", "p_name").alias("original_title"),
        F.col("p_retailprice").cast("string").alias("popularity"),
        F.col("p_size").cast("string").alias("runtime"),
        F.col("p_type").alias("status"),
    )


def film_run(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    """`raw_films` as two successive exports give it: films of one brand come, of one go, of one are reissued."""
    films = raw_films(spark, sf_dir)
    brand = F.substring_index("original_title", " ", 1)
    if run == 1:
        return films.where(brand != COMING_BRAND)
    reissued = brand == REISSUED_BRAND
    return films.where(brand != GOING_BRAND).withColumns(
        {
            "title": F.when(reissued, F.concat("title", F.lit(" II"))).otherwise(F.col("title")),
            "status": F.when(reissued, F.lit("REISSUE")).otherwise(F.col("status")),
        }
    )


def dated_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(film_id, rating, day): each rating with the day that it was given."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("bigint").alias("film_id"),
        (F.ceil(F.col("l_quantity") / 5) * F.lit(0.5)).cast("double").alias("rating"),
        F.col("l_shipdate").cast("date").alias("day"),
    )


def with_attributes(
    films: DataFrame, spark: SparkSession, sf_dir: str, *columns: str
) -> DataFrame:
    """Films of `raw_films` with their id, imdb_id and the columns asked for."""
    films = films.withColumns({"p_partkey": F.col("id").cast("bigint"), "p_type": F.col("status")})
    for add, added in _JOINED:
        if set(added) & set(columns):
            films = add(films, spark, sf_dir)
    return films.select("id", "imdb_id", *columns)


def raw_movies(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The metadata export with id, imdb_id and the columns asked for."""
    return with_attributes(raw_films(spark, sf_dir), spark, sf_dir, *columns)


def raw_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The companies export: all suppliers of a film, a row per film and block of suppliers."""
    name = F.when(F.col("s_acctbal") >= 0, F.replace("s_name", F.lit("#"), F.lit("\u00a0")))
    cells = (
        _film_suppliers(spark, sf_dir, "s_name", "s_acctbal")
        .withColumn("company", F.struct("s_suppkey", name.alias("name")))
        .groupBy("p_partkey", F.expr(f"s_suppkey div {COMPANY_BLOCK}").alias("block"))
        .agg(F.sort_array(F.collect_set("company")).alias("companies"))
    )
    printed = F.transform(
        "companies", lambda c: py_dict(id=py_number(c.s_suppkey), name=py_text(c["name"]))
    )
    return cells.select(
        F.col("p_partkey").cast("string").alias("id"),
        py_list(printed).alias("production_companies"),
    )


def raw_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keywords export: the words of a film's name."""
    words = F.transform(
        F.split("p_name", " "), lambda word, i: py_dict(id=py_number(i), name=py_text(word))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), py_list(words).alias("keywords")
    )


def raw_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The credits export: who ordered a film, by order status and block of customers."""
    segment = F.col("c_mktsegment")
    character = (
        F.when(F.col("c_acctbal") < 0, F.lit(None))
        .when(F.col("o_orderstatus") == "F", F.concat(segment, F.lit(" (voice)")))
        .when(F.col("o_orderstatus") == "O", F.concat(segment, F.lit("'s lead: None, true")))
        .otherwise(F.concat(F.lit('The "'), segment, F.lit("\" who won't, None")))
    )
    gender = F.when(F.col("c_acctbal") < 0, 0).when(segment < "F", 1).otherwise(2)
    # A member's text but for its film and its place is printed once per order, not
    # once per line item. Two such texts differ where what they print does, and sort
    # as it does: no printed value is the beginning of another.
    credit = F.concat_ws("-", F.col("c_custkey").cast("string"), "o_orderstatus")
    picture = F.when(gender > 0, F.concat(F.lit("/"), F.col("c_custkey").cast("string"), F.lit(".jpg")))
    buyer = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.concat(F.lit(", 'character': "), py_text(character), F.lit(", 'credit_id': '")).alias("before_film"),
        F.concat(
            credit,
            F.lit("', 'gender': "),
            py_number(gender),
            F.lit(", 'id': "),
            py_number(F.col("c_custkey")),
            F.lit(", 'name': "),
            py_text(F.col("c_name")),
            F.lit(", 'order': "),
        ).alias("after_film"),
        F.concat(F.lit(", 'profile_path': "), py_code(picture), F.lit("}")).alias("after_place"),
    )
    # All sides grow with the data. Their compressed size says little about the
    # rows, so the joins are told not to broadcast any of them.
    customers = table(spark, sf_dir, "customer").withColumn("o_custkey", F.col("c_custkey"))
    buyers = (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
        .join(customers.hint("merge"), "o_custkey")
        .select("l_orderkey", buyer.alias("buyer"))
    )
    cells = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_partkey")
        .join(buyers.hint("merge"), "l_orderkey")
        .groupBy("l_partkey", F.expr(f"buyer.id div {CAST_BLOCK}").alias("block"))
        .agg(F.sort_array(F.collect_set("buyer")).alias("members"))
    )
    damaged = (
        table(spark, sf_dir, "part")
        .where(F.col("p_brand") == DAMAGED_BRAND)
        .select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("damaged"))
        .distinct()
    )
    film = F.col("l_partkey").cast("string")
    prefix = F.coalesce(F.concat(film, F.lit("-")), F.lit(""))
    printed = F.transform(
        "members",
        lambda m, i: F.concat(
            F.lit("{'cast_id': "), py_number(i), m.before_film, prefix, m.after_film, py_number(i), m.after_place
        ),
    )
    # A damaged row is one more row: no member is lost with it.
    rows = cells.withColumn("cell", py_list(printed)).join(damaged, "l_partkey", "left")
    cut = F.left("cell", F.length("cell") - 2)
    copies = F.when(F.col("damaged"), F.array("cell", cut)).otherwise(F.array("cell"))
    return rows.select(film.alias("id"), F.explode(copies).alias("cast"))


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings export: one rating per line item, 0.5 to 5.0 in steps of 0.5."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("movieId"),
        (F.ceil(F.col("l_quantity") / 5) * 0.5).cast("string").alias("rating"),
    )


def damaged_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings export with texts that are no number, by quantity: ratings of 13, films of 17."""
    quantity = F.col("l_quantity")
    film = F.col("l_partkey").cast("string")
    rating = (F.ceil(quantity / 5) * 0.5).cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.when(quantity == 17, F.concat(F.lit("m"), film)).otherwise(film).alias("movieId"),
        F.when(quantity == 13, F.concat(rating, F.lit(" stars"))).otherwise(rating).alias("rating"),
    )


def damaged_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata export with values of a wrong form, by size: popularity of 7, runtime of 9."""
    films = raw_films(spark, sf_dir)
    size = F.col("runtime")
    return films.withColumns(
        {
            "popularity": F.when(size == "7", F.concat("popularity", F.lit("x"))).otherwise(
                F.col("popularity")
            ),
            "runtime": F.when(size == "9", "9 min").otherwise(size),
        }
    )


def poster_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poster locations, one per bare outside id."""
    urls = table(spark, sf_dir, "pages").groupBy("page_id").agg(F.min("url").alias("url"))
    return urls.select(outside_id(F.col("page_id")).alias("bare"), "url")


def poster_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature vector per poster."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("film_id"), F.col("embedding").alias("features")
    )
