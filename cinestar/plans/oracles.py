"""The registered queries as SQL over the test tables, without any text round trip.

Each statement states the result relationally: where the Spark query prints
collections, repairs, parses and explodes them, the SQL joins and unnests.
"""

from __future__ import annotations


def _key(*parts: str) -> str:
    """The md5 key over `length:text` parts."""
    texts = [f"CAST({part} AS VARCHAR)" for part in parts]
    joined = ", ".join(
        f"coalesce(CAST(length({text}) AS VARCHAR) || ':' || {text}, '~')" for text in texts
    )
    return f"md5(concat_ws('|', {joined}))"


def _outside_id(key: str) -> str:
    text = f"CAST({key} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest(7, length({text})) AS INTEGER), '0')"


_DENIED = "('0', 'tt0113002', 'tt2423504', 'tt2622826', 'tt0000000', 'tt0000003', 'tt0000007', 'tt0000011')"

# Of a film's copies the one with the fewest NULLs, then the smallest in the
# order of the export's columns.
_COPY = """PARTITION BY film_id ORDER BY
    CAST(imdb_id IS NULL AS INTEGER) + CAST(p_name IS NULL AS INTEGER) + CAST(p_retailprice IS NULL AS INTEGER)
      + CAST(p_size IS NULL AS INTEGER) + CAST(p_type IS NULL AS INTEGER),
    imdb_id NULLS FIRST, p_name NULLS FIRST, original_title NULLS FIRST,
    CAST(p_retailprice AS VARCHAR) NULLS FIRST, CAST(p_size AS VARCHAR) NULLS FIRST, p_type NULLS FIRST"""


def _one_copy(rows: str) -> str:
    return f"""SELECT * EXCLUDE (copy) FROM (
  SELECT *, row_number() OVER ({_COPY}) AS copy FROM {rows}) WHERE copy = 1"""


_ALL_FILMS = f"""
all_films AS (
  SELECT *, p_partkey AS film_id, concat_ws(' ', p_brand, p_name) AS original_title,
         CASE WHEN p_size < 50 THEN 'tt' || {_outside_id("p_partkey")} END AS imdb_id
  FROM part
)"""

_ACCEPTED = f"""{_ALL_FILMS},
accepted AS (SELECT * FROM all_films WHERE imdb_id NOT IN {_DENIED})"""

_FILMS = f"""{_ACCEPTED},
films AS ({_one_copy("accepted")})"""

_FACTS = f"""{_FILMS},
facts AS (SELECT film_id, p_name AS title, original_title FROM films)"""

_UNIQUE = f"""{_ALL_FILMS},
unique_films AS ({_one_copy("all_films")}),
posters AS (SELECT page_id, min(url) AS url FROM pages GROUP BY page_id)"""

_RATINGS = """
ratings AS (
  SELECT l_partkey AS film_id, CAST(0.5 * ceil(l_quantity / 5) AS DOUBLE) AS rating FROM lineitem
)"""

_TOTALS = f"""{_RATINGS},
totals AS (
  SELECT film_id, count(*) AS freq, count(rating) AS rated, sum(rating) AS rating_sum,
         avg(rating) AS rating
  FROM ratings GROUP BY film_id
)"""

_VOTES = f"""{_FACTS}, {_TOTALS},
votes AS (
  SELECT film_id, title, original_title, rating AS vote_average, coalesce(freq, 0) AS vote_count
  FROM facts LEFT JOIN totals USING (film_id)
)"""

_SALES = """
sales AS (
  SELECT l_partkey AS film_id, min(l_shipdate) AS first_ship,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS sales
  FROM lineitem GROUP BY l_partkey
)"""

_SUPPLIERS = f"""{_SALES},
film_suppliers AS (SELECT DISTINCT l_partkey AS film_id, l_suppkey AS s_suppkey FROM lineitem)"""

_COMPANIES = f"""{_SUPPLIERS},
company_rows AS (
  SELECT film_id, s_suppkey,
         row_number() OVER (PARTITION BY film_id, s_suppkey // 2048 ORDER BY s_suppkey) - 1 AS position,
         CASE WHEN s_acctbal >= 0 THEN replace(s_name, '#', chr(160)) END AS company_name
  FROM film_suppliers JOIN (SELECT DISTINCT s_suppkey, s_name, s_acctbal FROM supplier) s
  USING (s_suppkey)
)"""

_COUNTRIES = f"""{_SUPPLIERS},
country_rows AS (
  SELECT film_id, row_number() OVER (PARTITION BY film_id ORDER BY n_nationkey) - 1 AS position,
         n_name AS name
  FROM (SELECT DISTINCT film_id, n_nationkey, n_name
        FROM film_suppliers JOIN supplier USING (s_suppkey) JOIN nation ON n_nationkey = s_nationkey)
)"""

_GENRES = """
genre_rows AS (
  SELECT film_id, CAST('0x' || substr(md5(p_type), 1, 6) AS INTEGER) AS id, p_type AS name
  FROM {source}
  UNION ALL
  SELECT film_id, label + 100, 'g' || CAST(label AS VARCHAR)
  FROM {source} JOIN embeddings ON vec_id = film_id
)"""

_LANGUAGES = """
language_rows AS (
  SELECT film_id, upper(substr(lang, 1, 1)) || lower(substr(lang, 2)) AS languages
  FROM {source} JOIN documents ON doc_id = film_id
)"""

# Members of the credits cells: per film and block of 2048 customers, in the
# order of customer and status.
_MEMBERS = f"""
buyers AS (
  SELECT DISTINCT l_partkey AS film_id, c_custkey, o_orderstatus, c_name, c_custkey // 2048 AS block,
         CASE WHEN c_acctbal < 0 THEN NULL
              WHEN o_orderstatus = 'F' THEN c_mktsegment || ' (voice)'
              WHEN o_orderstatus = 'O' THEN c_mktsegment || '''s lead: None, true'
              ELSE 'The "' || c_mktsegment || '" who won''t, None' END AS character
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
),
cell_rows AS (
  SELECT *, row_number() OVER (PARTITION BY film_id, block ORDER BY c_custkey, o_orderstatus) - 1
           AS position
  FROM buyers
),
members AS (
  SELECT {_key("film_id", "film_id || '-' || c_custkey || '-' || o_orderstatus", "c_custkey", "position")} AS id,
         CAST(c_custkey AS INTEGER) AS cast_member_id, film_id, c_name AS name, character,
         CASE WHEN character LIKE '%(voice)%' THEN 'voice' ELSE 'actor/actress' END AS role
  FROM cell_rows
)"""

_WORDS = """
word_rows AS (
  SELECT DISTINCT film_id, i - 1 AS position, words[i] AS keyword
  FROM (SELECT film_id, words, unnest(range(1, len(words) + 1)) AS i
        FROM (SELECT p_partkey AS film_id, string_split(p_name, ' ') AS words FROM part))
)"""


def _cleaned_characters(filler: str) -> str:
    """Characters after `: None` -> `: null` in texts too, and with the escaped quote replaced.

    Only texts with both kinds of quotes are printed with an escape.
    """
    text = "replace(character, ': None', ': null')"
    escaped = f"replace({text}, chr(39), '{filler}')"
    return f"""WITH {_MEMBERS}
SELECT id, cast_member_id, film_id,
       CASE WHEN contains(character, '"') THEN {escaped} ELSE {text} END AS character
FROM members"""


def _scalar(attribute: str, value: str, source: str = "films", key: str = "id") -> str:
    name = f"'{attribute}'"
    return f"SELECT {_key('film_id', name)} AS {key}, film_id, {value} AS {attribute} FROM {source}"


def _rollup(rows: str, name: str) -> str:
    return f"""
SELECT r.{name}, count(*) AS films, coalesce(CAST(sum(freq) AS BIGINT), 0) AS votes,
       sum(rating_sum) / sum(rated) AS vote_average,
       CAST(sum(CAST(sales AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS revenue
FROM facts JOIN {rows} r USING (film_id) LEFT JOIN totals USING (film_id)
LEFT JOIN sales USING (film_id)
GROUP BY r.{name}"""


_RELEASE = "CAST(first_ship AS DATE)"
_REVENUE = "CAST(sales AS DECIMAL(18,2))"
_FILM_SALES = "films LEFT JOIN sales USING (film_id)"
_FILM_PAGES = "films LEFT JOIN pages ON page_id = film_id"
_FILM_DOCUMENTS = "films LEFT JOIN documents ON doc_id = film_id"
_LOCATED = "unique_films LEFT JOIN posters ON page_id = film_id AND imdb_id IS NOT NULL"

ORACLES: dict[str, str] = {
    "film_votes": f"WITH {_VOTES} SELECT * FROM votes",
    "ratings_count": f"WITH {_TOTALS} SELECT film_id AS movieId, freq FROM totals",
    "ratings_mean": f"WITH {_TOTALS} SELECT {_key('film_id')} AS id, film_id AS movieId, rating FROM totals",
    "ratings_filtered": f"""WITH {_RATINGS}
SELECT film_id, count(*) AS freq, avg(rating) AS rating FROM ratings WHERE rating > 2.5
GROUP BY film_id""",
    "ratings_remapped": f"""WITH {_RATINGS}
SELECT CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) AS film_id,
       count(*) AS freq, avg(rating) AS rating
FROM ratings JOIN (SELECT DISTINCT p_partkey, p_brand FROM part) ON p_partkey = film_id GROUP BY 1""",
    "fact_ratings": f"WITH {_RATINGS} SELECT film_id, rating FROM ratings",
    "fact_films": f"WITH {_FACTS} SELECT film_id AS id, title, original_title FROM facts",
    "films_denylist": f"WITH {_ACCEPTED} SELECT film_id, imdb_id, p_name AS title FROM accepted",
    "films_deny_table": f"""WITH {_ALL_FILMS}
SELECT film_id, imdb_id, p_name AS title FROM all_films
WHERE imdb_id IS NOT NULL
  AND film_id NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)""",
    "dim_countries": f"""WITH {_FILMS}, {_COUNTRIES}
SELECT {_key("film_id", "position", "name")} AS country_id, film_id, name
FROM films JOIN country_rows USING (film_id)""",
    "dim_genres": f"WITH {_FILMS}, {_GENRES.format(source='films')} SELECT id, film_id, name FROM genre_rows",
    "dim_companies": f"""WITH {_FILMS}, {_COMPANIES}
SELECT {_key("film_id", "s_suppkey", "position", "company_name")} AS company_id, film_id, company_name
FROM films JOIN company_rows USING (film_id)""",
    "dim_languages": f"""WITH {_FILMS}, {_LANGUAGES.format(source='films')}
SELECT {_key("film_id", "0", "languages")} AS id, {_key("film_id", "'spoken_languages'")} AS film_key,
       film_id, languages
FROM language_rows""",
    "film_keywords": f"""WITH {_WORDS}
SELECT {_key("film_id", "position", "keyword")} AS id, film_id, keyword FROM word_rows""",
    "dim_homepages": f"WITH {_FILMS} {_scalar('homepage', 'url', _FILM_PAGES, 'homepage_id')}",
    "dim_external_id": f"WITH {_FILMS} {_scalar('imdb_id', 'imdb_id')}",
    "dim_overview": f"WITH {_FILMS} {_scalar('overview', 'text', _FILM_DOCUMENTS)}",
    "dim_popularity": f"WITH {_FILMS} {_scalar('popularity', 'p_retailprice')}",
    "dim_release_date": f"WITH {_FILMS}, {_SALES} {_scalar('release_date', _RELEASE, _FILM_SALES)}",
    "dim_revenue": f"WITH {_FILMS}, {_SALES} {_scalar('revenue', _REVENUE, _FILM_SALES)}",
    "dim_runtime": f"WITH {_FILMS} {_scalar('runtime', 'CAST(p_size AS DOUBLE)')}",
    "dim_status": f"WITH {_FILMS} {_scalar('status', 'p_type')}",
    "dim_vote_average": f"WITH {_VOTES} {_scalar('vote_average', 'vote_average', 'votes')}",
    "dim_vote_count": f"WITH {_VOTES} {_scalar('vote_count', 'vote_count', 'votes')}",
    "dim_cast": f"WITH {_MEMBERS} SELECT id, cast_member_id, film_id, name FROM members",
    "dim_characters": f"WITH {_MEMBERS} SELECT id, cast_member_id, film_id, character FROM members",
    "dim_roles": f"WITH {_MEMBERS} SELECT id, cast_member_id, film_id, role FROM members",
    "dim_actors": f"""WITH {_MEMBERS}
SELECT id, cast_member_id, film_id, role FROM members WHERE role = 'actor/actress'""",
    "characters_strip": _cleaned_characters(""),
    "characters_space": _cleaned_characters(" "),
    "json_quarantine": f"""WITH {_MEMBERS},
cells AS (SELECT film_id, count(DISTINCT block) AS n FROM cell_rows GROUP BY film_id)
SELECT film_id, n + malformed AS cells, malformed
FROM (SELECT film_id, n, CASE WHEN film_id IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#7')
             THEN n ELSE 0 END AS malformed FROM cells)""",
    "ratings_unlinked": f"""WITH {_TOTALS}
SELECT film_id AS rating_id, freq, rated FROM totals
WHERE film_id NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)""",
    "ratings_quarantine": """
SELECT CASE WHEN l_quantity = 17 THEN 'm' ELSE '' END || CAST(l_partkey AS VARCHAR) AS "movieId",
       CAST(CAST(0.5 * ceil(l_quantity / 5) AS DECIMAL(3,1)) AS VARCHAR)
         || CASE WHEN l_quantity = 13 THEN ' stars' ELSE '' END AS rating
FROM lineitem WHERE l_quantity IN (13, 17)""",
    "scalar_quarantine": f"""WITH {_UNIQUE}
SELECT film_id, CASE WHEN p_size = 7 THEN 'popularity' ELSE 'runtime' END AS "column",
       CASE WHEN p_size = 7 THEN CAST(p_retailprice AS VARCHAR) || 'x' ELSE '9 min' END AS raw
FROM unique_films WHERE p_size IN (7, 9)""",
    "event_props": "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "conversation_turns": "SELECT conv_id, turn, role, text FROM conversations",
    "csv_roundtrip": "SELECT doc_id, nullif(lang, '') AS lang, nullif(text, '') AS text FROM documents",
    "csv_single_line": f"""WITH {_MEMBERS}
SELECT film_id, count(*) AS members,
       CAST(sum(CASE WHEN role = 'voice' THEN 1 ELSE 0 END) AS BIGINT) AS voices
FROM members GROUP BY film_id""",
    "parquet_stage": f"WITH {_RATINGS} SELECT film_id, rating FROM ratings",
    "daily_rerun": f"""WITH {_RATINGS}
SELECT run_date, rating, count(*) AS freq
FROM ratings, (VALUES ('2024-01-01'), ('2024-01-02')) runs(run_date) GROUP BY run_date, rating""",
    "top_films": f"WITH {_VOTES} SELECT * FROM votes ORDER BY vote_count DESC, film_id LIMIT 20",
    "hash_keys": f"""WITH {_WORDS}
SELECT {_key("film_id", "position", "keyword")} AS row_key, {_key("film_id")} AS film_key, film_id
FROM word_rows""",
    "dense_keys": f"""WITH {_FACTS}
SELECT row_number() OVER (ORDER BY film_id) - 1 AS id, film_id, title, original_title FROM facts""",
    "range_slices": f"""WITH {_UNIQUE},
numbered AS (
  SELECT row_number() OVER (ORDER BY film_id) - 1 AS id, count(*) OVER () AS films, film_id
  FROM unique_films WHERE imdb_id IS NOT NULL
)
SELECT id, film_id, ((id + 1) * 5 - 1) // films AS slice FROM numbered""",
    "star_films": f"""WITH {_VOTES}, {_SALES}
SELECT v.film_id, v.title, v.original_title, url AS homepage, p_retailprice AS popularity,
       {_RELEASE} AS release_date, {_REVENUE} AS revenue, CAST(p_size AS DOUBLE) AS runtime,
       p_type AS status, imdb_id, text AS overview, vote_average, vote_count
FROM votes v JOIN films f ON f.film_id = v.film_id LEFT JOIN pages ON page_id = v.film_id
LEFT JOIN documents ON doc_id = v.film_id
LEFT JOIN sales s ON s.film_id = v.film_id""",
    "star_by_genre": f"WITH {_FACTS}, {_TOTALS}, {_SALES}, {_GENRES.format(source='films')} {_rollup('genre_rows', 'name')}",
    "star_by_country": f"WITH {_FACTS}, {_TOTALS}, {_COUNTRIES} {_rollup('country_rows', 'name')}",
    "star_by_company": f"WITH {_FACTS}, {_TOTALS}, {_COMPANIES} {_rollup('company_rows', 'company_name')}",
    "star_by_language": f"WITH {_FACTS}, {_TOTALS}, {_SALES}, {_LANGUAGES.format(source='facts')} {_rollup('language_rows', 'languages')}",
    "poster_locations": f"WITH {_UNIQUE} SELECT film_id, imdb_id, url FROM {_LOCATED}",
    "poster_slices_union": f"""WITH {_UNIQUE}
SELECT film_id, imdb_id, 'https://posters.example.org/' || substr(imdb_id, 3) || '.jpg' AS url
FROM unique_films""",
    "film_posters": f"""WITH {_FACTS},
posters AS (SELECT page_id, min(url) AS url FROM pages GROUP BY page_id)
SELECT film_id, title, original_title, url AS poster FROM facts LEFT JOIN posters ON page_id = film_id""",
    "poster_labels": f"""WITH {_UNIQUE}, {_GENRES.format(source='unique_films')}
SELECT film_id, url, name AS genre FROM {_LOCATED} JOIN genre_rows USING (film_id)
WHERE url IS NOT NULL""",
}
_TRAINING = """CAST('0x' || substr(md5(CAST(film_id AS VARCHAR)), 1, 7) AS BIGINT) % 100 {} 20"""

# The genres known to the model are those of its training posters.
_SCORED = f"""{_UNIQUE}, {_GENRES.format(source="unique_films")},
examples AS (SELECT DISTINCT film_id, name FROM genre_rows JOIN embeddings ON vec_id = film_id),
known AS (SELECT DISTINCT name FROM examples WHERE {_TRAINING.format(">=")})"""

ORACLES["genre_score_shapes"] = f"""WITH {_SCORED},
n AS (SELECT count(*) AS genres FROM known)
SELECT vec_id AS film_id, genres, CAST(genres * (genres + 1) // 2 AS BIGINT) AS ranks,
       CAST(1 AS DOUBLE) AS probability, true AS descending
FROM embeddings, n"""
ORACLES["genre_holdout"] = f"""WITH {_SCORED}
SELECT film_id, count(*) AS genres FROM examples JOIN known USING (name)
WHERE {_TRAINING.format("<")} GROUP BY film_id"""
ORACLES["json_infer"] = ORACLES["dim_countries"]
ORACLES["table_overwrite"] = ORACLES["dim_genres"]
ORACLES["csv_blocks"] = ORACLES["csv_roundtrip"]


# Two successive exports, one copy of each film.
_RUNS = f"""{_ALL_FILMS},
run_rows AS (
  SELECT 1 AS run, * FROM all_films WHERE p_brand <> 'Brand#3'
  UNION ALL
  SELECT 2, * REPLACE (CASE WHEN p_brand = 'Brand#5' THEN p_name || ' II' ELSE p_name END AS p_name,
                       CASE WHEN p_brand = 'Brand#5' THEN 'REISSUE' ELSE p_type END AS p_type)
  FROM all_films WHERE p_brand <> 'Brand#7'),
runs AS (
  SELECT * EXCLUDE (copy) FROM (
    SELECT *, row_number() OVER ({_COPY.replace("PARTITION BY film_id", "PARTITION BY run, film_id")}) AS copy
    FROM run_rows) WHERE copy = 1),
days AS (SELECT * FROM (VALUES (1, '1995-01-01'), (2, '1997-01-01')) d(run, day))"""

_DATED = """
dated AS (
  SELECT l_partkey AS film_id, CAST(0.5 * ceil(l_quantity / 5) AS DOUBLE) AS rating,
         CAST(l_shipdate AS DATE) AS day
  FROM lineitem)"""

# Genres of a run's films, each pair with a film once.
_RUN_GENRES = """
run_pairs AS (
  SELECT run, film_id, CAST('0x' || substr(md5(p_type), 1, 6) AS INTEGER) AS id, p_type AS name FROM runs
  UNION ALL
  SELECT run, film_id, label + 100, 'g' || CAST(label AS VARCHAR)
  FROM runs JOIN embeddings ON vec_id = film_id)"""

ORACLES["published_versions"] = f"""WITH {_DATED}
SELECT CAST(1 AS BIGINT) AS version, rating, count(*) AS freq FROM dated WHERE day < DATE '1996-01-01' GROUP BY rating
UNION ALL
SELECT 2, rating, count(*) FROM dated GROUP BY rating"""
ORACLES["votes_by_increments"] = f"WITH {_TOTALS} SELECT film_id, freq, rated, rating FROM totals"
ORACLES["run_changes"] = f"""WITH {_ALL_FILMS},
sides AS (
  SELECT film_id, bool_or(p_brand <> 'Brand#3') AS before, bool_or(p_brand <> 'Brand#7') AS after,
         bool_or(p_brand IN ('Brand#3', 'Brand#5', 'Brand#7')) AS touched
  FROM all_films GROUP BY film_id)
SELECT film_id, CASE WHEN NOT before THEN 'insert' WHEN NOT after THEN 'delete' ELSE 'update' END AS change
FROM sides WHERE touched"""
ORACLES["run_genres"] = f"WITH {_RUNS}, {_RUN_GENRES} SELECT id, film_id, name FROM run_pairs WHERE run = 2"
ORACLES["vault_states"] = f"""WITH {_RUNS}
SELECT day, film_id, p_name AS title, p_type AS status FROM runs JOIN days USING (run)"""
ORACLES["vault_loads"] = f"""WITH {_RUNS}
SELECT {_key("film_id")} AS film_key, day, false AS deleted, p_name AS title
FROM runs JOIN days USING (run) WHERE run = 1 OR p_brand IN ('Brand#3', 'Brand#5')
UNION ALL
SELECT {_key("film_id")}, '1997-01-01', true, NULL FROM runs WHERE run = 1 AND p_brand = 'Brand#7'"""
ORACLES["vault_links"] = f"""WITH {_RUNS}, {_RUN_GENRES}
SELECT {_key("film_id", "name")} AS key, {_key("film_id")} AS film_id_key, {_key("name")} AS name_key,
       min(day) AS day
FROM run_pairs JOIN days USING (run) GROUP BY film_id, name"""
ORACLES["vault_ratings"] = f"""WITH {_RUNS}, {_DATED}
SELECT d.film_id, p_name AS title, count(*) AS freq
FROM dated d LEFT JOIN runs r ON r.film_id = d.film_id AND r.run = CASE
  WHEN d.day >= DATE '1997-01-01' THEN 2 WHEN d.day >= DATE '1995-01-01' THEN 1 END
GROUP BY d.film_id, p_name"""
ORACLES["films_by_genre_and_country"] = f"""WITH {_FILMS}, {_COUNTRIES}, {_GENRES.format(source="films")},
all_pairs AS (
  SELECT f.film_id, g.name AS genre, c.name AS country
  FROM films f LEFT JOIN genre_rows g USING (film_id) LEFT JOIN country_rows c USING (film_id))
SELECT genre, country, grouping(genre, country) AS level, count(DISTINCT film_id) AS films
FROM all_pairs GROUP BY GROUPING SETS ((genre, country), (genre), (country), ())"""


def _persons(person: str) -> str:
    return f"""WITH {_MEMBERS},
credits AS (
  SELECT CAST({person} AS INTEGER) AS cast_member_id, name,
         nullif(CASE WHEN c_acctbal < 0 THEN 0 WHEN c_mktsegment < 'F' THEN 1 ELSE 2 END, 0) AS gender
  FROM members JOIN customer ON c_custkey = cast_member_id),
names AS (
  SELECT *, row_number() OVER (PARTITION BY cast_member_id ORDER BY n DESC, name) AS place
  FROM (SELECT cast_member_id, name, count(*) AS n FROM credits WHERE name IS NOT NULL GROUP BY ALL)),
genders AS (
  SELECT *, row_number() OVER (PARTITION BY cast_member_id ORDER BY n DESC, gender) AS place
  FROM (SELECT cast_member_id, gender, count(*) AS n FROM credits WHERE gender IS NOT NULL GROUP BY ALL)),
counted AS (
  SELECT cast_member_id, count(DISTINCT name) AS names, count(DISTINCT gender) AS genders, count(*) AS credits
  FROM credits GROUP BY cast_member_id)
SELECT {_key("c.cast_member_id")} AS id, c.cast_member_id, n.name, coalesce(g.gender, 0) AS gender,
       names, genders, credits
FROM counted c LEFT JOIN names n ON n.cast_member_id = c.cast_member_id AND n.place = 1
LEFT JOIN genders g ON g.cast_member_id = c.cast_member_id AND g.place = 1"""


ORACLES["dim_person"] = _persons("cast_member_id")
ORACLES["person_clashes"] = _persons("cast_member_id // 8")
ORACLES["lookups_resumed"] = f"""WITH {_UNIQUE}
SELECT film_id, imdb_id, 'https://posters.example.org/' || substr(imdb_id, 3) || '.jpg' AS url,
       CAST(NULL AS VARCHAR) AS error, CASE WHEN imdb_id LIKE '%7' THEN 2 ELSE 1 END::BIGINT AS tries
FROM unique_films WHERE imdb_id IS NOT NULL"""
# The fields of the made exports: those of turns that are there at all.
ORACLES["schema_drift"] = """
SELECT field, change, before, after FROM (VALUES
  ('[].turn', 'type', 'bigint', 'string'), ('[].size', 'new', NULL, 'bigint')) d(field, change, before, after)
WHERE EXISTS (SELECT 1 FROM conversations)"""
ORACLES["drift_kept"] = """
SELECT conv_id, CAST(NULL AS BIGINT) AS turn, role, text, 't' || CAST(turn AS VARCHAR) AS turn_text,
       CAST(length(text) AS BIGINT) AS size
FROM conversations"""
ORACLES["genre_folds"] = f"""WITH {_SCORED}
SELECT CAST('0x' || substr(md5(CAST(film_id AS VARCHAR)), 1, 7) AS BIGINT) % 5 AS fold, name AS genre,
       count(DISTINCT film_id) AS posters
FROM examples GROUP BY ALL"""
