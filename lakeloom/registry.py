"""Registered queries of the record-linkage engine, over whole tables, and their SQL.

Records are the stand-ins of lakeloom.sources.records; truth is equal raw text
between an anchor and a target. Counts are BIGINT, ratios rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import normalize as N
from lakeloom.functions import similarity as S
from lakeloom.operators import blocking as B
from lakeloom.operators import decision as D
from lakeloom.operators import evaluate as E
from lakeloom.operators import features as X
from lakeloom.operators import groups as G
from lakeloom.operators import model as M
from lakeloom.operators import validate as V
from lakeloom.plans.linkage import sides
from lakeloom.sources import records as R
from lakeloom.sources import tsv
from lakeloom.sources.stage import new_path, written

FLAGSHIP = "assemble_matches"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
THRESHOLD = 0.5
STOP_WORDS = ["que", "die", "und", "for", "this", "with", "are", "pour", "nicht", "los"]

# pieces of SQL -------------------------------------------------------------------

_WORDS = "|".join(w for w in N.LEGAL_SUFFIXES if " " not in w)


def _clean(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(strip_accents(lower(coalesce({x}, ''))), '[^\\x00-\\x7F]', '', 'g'), '[^A-Za-z0-9_]+', ' ', 'g'))"


def _name(x: str) -> str:
    alias = f"case when contains({x}, ' dba ') then string_split({x}, ' dba ')[-1] when contains({x}, ' doing business as ') then string_split({x}, ' doing business as ')[-1] else {x} end"
    return f"regexp_replace({alias}, '(^| )({_WORDS})( ({_WORDS}))*$', '')"


def _address(x: str) -> str:
    words = "map {" + ", ".join(f"'{a}': '{b}'" for a, b in N.ADDRESS_WORDS.items()) + "}"
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda w: coalesce({words}[w], w)), ' ')"


def _country(x: str) -> str:
    whens = " ".join(f"when {x} in ({', '.join(repr(n) for n in names)}) then '{code}'" for code, names in N.COUNTRIES.items())
    return f"case {whens} else {x} end"


def _tokens(x: str) -> str:
    return f"list_distinct(list_filter(string_split({x}, ' '), lambda w: w <> ''))"


def _grams(x: str, n: int) -> str:
    bare = f"replace({x}, ' ', '')"
    return f"list_distinct(list_transform(range(1, greatest(length({bare}) - {n} + 2, 1)), lambda i: substr({bare}, i, {n})))"


def _jaccard(a: str, b: str) -> str:
    both = f"len(list_intersect({_tokens(a)}, {_tokens(b)}))"
    return f"case when {a} = '' or {b} = '' then 0.0 else {both}::double / (len({_tokens(a)}) + len({_tokens(b)}) - {both}) end"


RECORDS = f"""
cleaned as materialized (select doc_id, text, lang, {_clean("text")} as t from documents),
split as (select *, string_split(t, ' ') as w from cleaned),
records as materialized (
    select 'S' || (doc_id % 3 + 1) || '-' || doc_id as record_id, array_to_string(w[1:6], ' ') as name, array_to_string(w[greatest(len(w) - 5, 1):len(w)], ' ') as address, lang as country, text
    from split
),
anchors as (select * from records where starts_with(record_id, 'S1-')),
targets as (select * from records where not starts_with(record_id, 'S1-')),
truth as (select distinct a.record_id as id_1, b.record_id as id_2 from anchors a join targets b on a.text = b.text)"""
PARTIES = f"""
records as materialized (
    select 'S1-' || c_custkey as record_id, {_clean("c_name")} as name, lower(c_mktsegment) as address, lower(n_name) as country from customer left join nation on c_nationkey = n_nationkey
    union all select 'S2-' || s_suppkey, {_clean("s_name")}, '', lower(n_name) from supplier left join nation on s_nationkey = n_nationkey
    union all select 'S3-' || p_partkey, {_clean("p_name")}, {_clean("p_type")}, '' from part
),
anchors as (select * from records where starts_with(record_id, 'S1-')),
targets as (select * from records where not starts_with(record_id, 'S1-'))"""


def _rare(name: str, column: str, cap: int) -> str:
    keyed = lambda t: f"(select distinct record_id, unnest({_tokens(column)}) as key from {t})"
    return f"""
{name}_post as materialized (select record_id, key from {keyed("targets")} where length(key) > 2),
{name}_rare as (select key from {name}_post group by key having count(*) <= {cap}),
{name} as (select distinct a.record_id as id_1, p.record_id as id_2 from {keyed("anchors")} a join {name}_post p using (key) join {name}_rare using (key) where length(a.key) > 2)"""


EXACT = "exact_name as (select distinct a.record_id as id_1, b.record_id as id_2 from anchors a join targets b on trim(a.name) = trim(b.name) where trim(a.name) <> '')"
CANDIDATES = f"{EXACT}, {_rare('rare_name', 'name', 10)}, {_rare('rare_address', 'address', 10)}, candidates as materialized (select * from exact_name union select * from rare_name union select * from rare_address)"
SCORED = f"""
wide as (select c.id_1, c.id_2, a.name as n1, b.name as n2, a.address as a1, b.address as a2 from candidates c join records a on a.record_id = c.id_1 join records b on b.record_id = c.id_2),
scored as materialized (
    select id_1, id_2, ({_jaccard("n1", "n2")} + {_jaccard("a1", "a2")}) / 2 as score, case when t.id_1 is null then 0 else 1 end as label
    from wide left join truth t using (id_1, id_2)
)"""
ALL = f"with {RECORDS}, {CANDIDATES}, {SCORED}"

# pieces of Spark -----------------------------------------------------------------


def query(sql: str | None = None) -> Callable:
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in records as a written table: blockers, attributes and truth all read them, and texts are normalized once."""
    return written(R.from_documents(spark, sf_dir), "records")


def _truth(records: DataFrame) -> DataFrame:
    a, t = sides(records.select("record_id", "text_id"))
    return a.select(F.col("record_id").alias("id_1"), "text_id").join(t.select(F.col("record_id").alias("id_2"), "text_id"), "text_id").select("id_1", "id_2").distinct()


def _candidates(records: DataFrame) -> DataFrame:
    return B.retrieve(*sides(records.select("record_id", "name", "address")))


def _groups(spark: SparkSession, sf_dir: str) -> tuple[G.Groups, DataFrame]:
    """The stand-in records by groups of equal ones, and the pairs of groups that are candidates."""
    g = G.grouped(_records(spark, sf_dir))
    return g, G.retrieve(g)


def _group_scores(g: G.Groups, pairs: DataFrame) -> DataFrame:
    """Pairs of groups with the unsupervised score of the two set similarities."""
    wide = X.attributes(pairs, g.groups, ["name", "address"])
    rows = wide.select("id_1", "id_2", S.jaccard(F.col("name_1"), F.col("name_2")).alias("name_jaccard"), S.jaccard(F.col("address_1"), F.col("address_2")).alias("addr_jaccard"))
    return X.baseline_score(rows).select("id_1", "id_2", "score")


def _r6(c: str) -> Column:
    return F.round(F.col(c), 6).alias(c)


# normalization -------------------------------------------------------------------


@query(f"select doc_id, {_clean('text')} as cleaned from documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", N.clean_text("text").alias("cleaned"))


@query(f"with c as (select doc_id, {_clean('text')} as t from documents) select doc_id, {_name('t')} as name from c")
def normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", N.clean_text("text").alias("t")).select("doc_id", N.clean_name(F.col("t")).alias("name"))


@query(f"with c as (select doc_id, {_clean('text')} as t from documents) select doc_id, {_address('t')} as address from c")
def normalize_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", N.clean_text("text").alias("t")).select("doc_id", N.clean_address(F.col("t")).alias("address"))


@query(f"with c as (select n_nationkey, {_clean('n_name')} as t from nation) select n_nationkey, {_country('t')} as country from c")
def normalize_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "nation").select("n_nationkey", N.clean_text("n_name").alias("t")).select("n_nationkey", N.clean_country(F.col("t")).alias("country"))


@query(f"with c as (select doc_id, {_clean('text')} as t from documents) select doc_id, len({_tokens('t')})::bigint as n_tokens, array_to_string(list_sort({_tokens('t')}), ' ') as tokens from c")
def tokens_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _table(spark, sf_dir, "documents").select("doc_id", N.tokens(N.clean_text("text")).alias("w"))
    return words.select("doc_id", F.size("w").cast("long").alias("n_tokens"), F.array_join(F.array_sort("w"), " ").alias("tokens"))


@query(f"with c as (select p_partkey, {_clean('p_name')} as t from part) select p_partkey, len({_grams('t', 3)})::bigint as n_grams, array_to_string(list_sort({_grams('t', 3)}), ' ') as grams from c")
def char_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = _table(spark, sf_dir, "part").select("p_partkey", N.clean_text("p_name").alias("t"))
    grams = cleaned.select("p_partkey", N.char_ngrams("t", 3).alias("g"))
    return grams.select("p_partkey", F.size("g").cast("long").alias("n_grams"), F.array_join(F.array_sort("g"), " ").alias("grams"))


# sources, filters, splits --------------------------------------------------------


@query(f"with {PARTIES} select * from records")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.from_parties(spark, sf_dir)


@query(f"with {RECORDS} select record_id, name, address, country, starts_with(record_id, 'S1-') as is_anchor from records")
def anchors_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.from_documents(spark, sf_dir).select("record_id", "name", "address", "country", R.is_anchor().alias("is_anchor"))


@query(f"with {RECORDS} select record_id, record_id in (select id_1 from truth) as has_truth from anchors")
def semi_anti_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir)
    anchors, known = sides(records)[0].select("record_id"), _truth(records).select(F.col("id_1").alias("record_id")).distinct()
    return anchors.join(known, "record_id", "left_semi").withColumn("has_truth", F.lit(True)).unionAll(anchors.join(known, "record_id", "left_anti").withColumn("has_truth", F.lit(False)))


@query(f"with {RECORDS}, k as (select count(distinct id_1) as n from truth) select least(300, (select count(*) from anchors))::bigint as sampled, least(300, n)::bigint as with_truth from k")
def anchor_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capped training sample; the cap is the operator's own, scaled to the test tables."""
    records = _records(spark, sf_dir)
    known = _truth(records).select(F.col("id_1").alias("anchor")).distinct()
    chosen = E.capped_anchors(sides(records)[0].select("record_id"), known, 300)
    return chosen.join(known.withColumn("t", F.lit(1)), F.col("record_id") == F.col("anchor"), "left").agg(F.count("*").alias("sampled"), F.count("t").alias("with_truth"))


@query(f"{ALL}, n as (select label, count(*) as n from scored group by label) select label, ceil(0.2 * n)::bigint as held_out, (n - ceil(0.2 * n))::bigint as trained from n")
def stratified_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, pairs = _groups(spark, sf_dir)
    split = E.holdout(g.expanded(pairs, label=True))
    return split.groupBy("label").agg(F.sum(F.col("held_out").cast("long")).alias("held_out"), F.sum((~F.col("held_out")).cast("long")).alias("trained"))


# blocking ------------------------------------------------------------------------


@query(f"with {RECORDS}, {EXACT} select * from exact_name")
def block_exact_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.exact_name(*sides(_records(spark, sf_dir)))


@query(f"with {RECORDS}, g as (select trim(name) as key, min(record_id) as group_id from records where trim(name) <> '' group by all having bool_or(starts_with(record_id, 'S1-')) and not bool_and(starts_with(record_id, 'S1-'))) select record_id, starts_with(record_id, 'S1-') as anchor, group_id from records join g on trim(name) = key")
def block_exact_name_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of equal names in a row for each record: what grows with the input where pairs grow with its square."""
    return B.exact_name_groups(*sides(_records(spark, sf_dir)))


@query(f"with {RECORDS}, {EXACT}, few as (select trim(name) as key from targets group by key having count(*) <= 3) select id_1, id_2 from exact_name join targets on record_id = id_2 where trim(name) in (select key from few)")
def block_exact_name_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal names that at most three targets have: the opt-in frequency limit."""
    return B.exact_name(*sides(_records(spark, sf_dir)), max_name_freq=3)


@query(f"with {RECORDS}, {_rare('rare_name', 'name', 10)} select * from rare_name")
def block_rare_token_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.rare_token(*sides(_records(spark, sf_dir)), "name", 10)


@query(f"with {RECORDS}, {_rare('rare_address', 'address', 10)} select * from rare_address")
def block_rare_token_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.rare_token(*sides(_records(spark, sf_dir)), "address", 10)


@query(
    f"""with {RECORDS},
    post as materialized (select record_id, unnest({_grams("name", 3)}) as key from targets),
    rare as (select key from post group by key having count(*) <= 200),
    asked as (select record_id, unnest({_grams("name", 3)}) as key from anchors)
    select a.record_id as id_1, p.record_id as id_2 from asked a join post p using (key) join rare using (key) group by all having count(*) >= 2"""
)
def block_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.ngram(*sides(_records(spark, sf_dir)))


def _token_sql(column: str, cap: int) -> str:
    return f"""select distinct a.record_id as id_1, b.record_id as id_2 from {column}_key a join {column}_key b using (key) join {column}_ok using (key) where a.record_id < b.record_id"""


def _token_with(column: str, cap: int) -> str:
    return f"""{column}_key as materialized (select record_id, key from (select record_id, unnest({_tokens(column)}) as key from records) where length(key) > 2),
    {column}_ok as (select key from {column}_key group by key having count(*) between 2 and {cap})"""


@query(f"with {RECORDS}, {_token_with('name', 20)} {_token_sql('name', 20)}")
def block_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.token(_records(spark, sf_dir), "name", max_token_freq=20)


@query(f"with {RECORDS}, {_token_with('name', 20)} {_token_sql('name', 20)} and key not in ({', '.join(map(repr, STOP_WORDS))})")
def block_token_stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.token(_records(spark, sf_dir), "name", STOP_WORDS, 20)


@query(f"with {RECORDS}, {_token_with('name', 20)}, {_token_with('address', 20)} {_token_sql('name', 20)} union {_token_sql('address', 20)}")
def block_layered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.layered(_records(spark, sf_dir))


@query("with r as (select 'S3-' || p_partkey as record_id, p_brand, p_type, p_size from part) select a.record_id as id_1, b.record_id as id_2 from r a join r b using (p_brand, p_type, p_size) where a.record_id < b.record_id")
def block_exact_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part").withColumn("record_id", F.concat(F.lit("S3-"), F.col("p_partkey").cast("string")))
    return B.exact_key(part, ["p_brand", "p_type", "p_size"])


@query("with r as (select 'S3-' || p_partkey as record_id, case when p_partkey % 5 = 0 then null when p_partkey % 7 = 0 then '' else p_brand end as k, p_type, p_size from part) select a.record_id as id_1, b.record_id as id_2 from r a join r b using (k, p_type, p_size) where a.record_id < b.record_id")
def block_exact_key_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null keys pair with nothing, blank ones with one another."""
    part = _table(spark, sf_dir, "part").withColumn("record_id", F.concat(F.lit("S3-"), F.col("p_partkey").cast("string")))
    return B.exact_key(part.withColumn("k", F.when(F.col("p_partkey") % 5 == 0, None).when(F.col("p_partkey") % 7 == 0, "").otherwise(F.col("p_brand"))), ["k", "p_type", "p_size"])


@query(f"with {PARTIES}, {_rare('rare_name', 'name', 100)} select * from rare_name")
def block_rare_token_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.rare_token(*sides(R.from_parties(spark, sf_dir)), "name", 100)


@query(f"with {RECORDS}, {CANDIDATES} select * from candidates")
def candidates_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, pairs = _groups(spark, sf_dir)
    return g.expanded(pairs)


@query(f"with {RECORDS}, {CANDIDATES} select record_id as source1_entity_id, coalesce(string_agg(id_2, ',' order by id_2), '') as candidate_entity_ids from anchors left join candidates on id_1 = record_id group by record_id")
def candidate_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, pairs = _groups(spark, sf_dir)
    return g.lists(pairs, "candidate_entity_ids")


# features, scores, labels --------------------------------------------------------


def _exact(a: str, b: str) -> str:
    return f"case when {a} = '' or {b} = '' then 0.0 else ({a} = {b})::int::double end"


@query(f"with {RECORDS}, {CANDIDATES}, wide as (select c.*, a.name as n1, b.name as n2, a.address as a1, b.address as a2 from candidates c join records a on a.record_id = c.id_1 join records b on b.record_id = c.id_2) select id_1, id_2, {_exact('n1', 'n2')} as name_exact_match, round({_jaccard('n1', 'n2')}, 6) as name_jaccard, {_exact('a1', 'a2')} as addr_exact_match, round({_jaccard('a1', 'a2')}, 6) as addr_jaccard from wide")
def features_exact_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, pairs = _groups(spark, sf_dir)
    n1, n2, a1, a2 = (F.col(c) for c in ("name_1", "name_2", "address_1", "address_2"))
    wide = X.attributes(pairs, g.groups, ["name", "address"])
    return g.expanded(wide.select("id_1", "id_2", S.exact_match(n1, n2).alias("name_exact_match"), F.round(S.jaccard(n1, n2), 6).alias("name_jaccard"), S.exact_match(a1, a2).alias("addr_exact_match"), F.round(S.jaccard(a1, a2), 6).alias("addr_jaccard")))


@query(f"with {RECORDS}, {CANDIDATES} select id_1, id_2, -1.0::double as city_match, -1.0::double as state_match, case when a.country = '' or b.country = '' then -1.0 else (a.country = b.country)::int::double end as country_match, -1.0::double as zip_match from candidates join records a on a.record_id = id_1 join records b on b.record_id = id_2")
def features_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, pairs = _groups(spark, sf_dir)
    return g.expanded(X.attributes(pairs, g.groups, list(X.AGREEMENTS.values())).select("id_1", "id_2", *X.agreement_features()))


_PLACES = """
places as materialized (
    select 'S1-' || c_custkey as record_id, c_custkey % 100 as k, case when c_custkey % 7 = 0 then '' else n_name end as city, r_name as state, (c_custkey % 3)::varchar as zip_code from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    union all select 'S2-' || s_suppkey, s_suppkey % 100, n_name, case when s_suppkey % 5 = 0 then '' else r_name end, (s_suppkey % 3)::varchar from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
)"""


def _agree(c: str) -> str:
    return f"case when a.{c} = '' or b.{c} = '' then -1.0 else (a.{c} = b.{c})::int::double end"


@query(f"with {_PLACES} select a.record_id as id_1, b.record_id as id_2, {_agree('city')} as city_match, {_agree('state')} as state_match, -1.0::double as country_match, {_agree('zip_code')} as zip_match from places a join places b using (k) where starts_with(a.record_id, 'S1-') and starts_with(b.record_id, 'S2-')")
def agreement_of_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City, state and zip agreement of customers and suppliers of one last two digits, some of them blank."""
    nation = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))

    def side(table: str, source: str, key: str, home: str, blank: int, column: str) -> DataFrame:
        place = _table(spark, sf_dir, table).join(F.broadcast(nation), F.col(home) == F.col("n_nationkey"))
        value = lambda c: F.when((F.col(key) % blank == 0) & F.lit(c == column), "").otherwise(F.col(c))
        return place.select(F.concat(F.lit(source), F.col(key).cast("string")).alias("record_id"), (F.col(key) % 100).alias("k"), value("n_name").alias("city"), value("r_name").alias("state"), (F.col(key) % 3).cast("string").alias("zip_code"))

    a, b = side("customer", "S1-", "c_custkey", "c_nationkey", 7, "n_name"), side("supplier", "S2-", "s_suppkey", "s_nationkey", 5, "r_name")
    pairs = a.select(F.col("record_id").alias("id_1"), "k").join(b.select(F.col("record_id").alias("id_2"), "k"), "k").drop("k")
    return X.attributes(pairs, a.unionByName(b).drop("k"), list(X.AGREEMENTS.values())).select("id_1", "id_2", *X.agreement_features())


@query(f"with {RECORDS}, {CANDIDATES}, wide as (select c.*, a.name as n1, b.name as n2, a.address as a1, b.address as a2, a.country as c1, b.country as c2 from candidates c join records a on a.record_id = c.id_1 join records b on b.record_id = c.id_2) select id_1, id_2, {_exact('n1', 'n2')} as name_exact_match, round({_jaccard('n1', 'n2')}, 6) as name_jaccard, {_exact('a1', 'a2')} as addr_exact_match, round({_jaccard('a1', 'a2')}, 6) as addr_jaccard, -1.0::double as city_match, -1.0::double as state_match, case when c1 = '' or c2 = '' then -1.0 else (c1 = c2)::int::double end as country_match, -1.0::double as zip_match from wide")
def features_but_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What features_all gives, without the two sequence ratios, which SQL cannot say."""
    g, pairs = _groups(spark, sf_dir)
    out = X.build_features(g.groups, pairs).drop("name_seq_matcher", "addr_seq_matcher")
    return g.expanded(out.withColumns({c: F.round(c, 6) for c in ("name_jaccard", "addr_jaccard")}))


@query(f"{ALL} select id_1, id_2, round(score, 6) as score from scored")
def baseline_score_of_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unsupervised score of the two set similarities: the mean of those present."""
    g, pairs = _groups(spark, sf_dir)
    return g.expanded(_group_scores(g, pairs).select("id_1", "id_2", _r6("score")))


@query()
def features_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten features; the sequence ratio has no SQL (tests compare it with difflib)."""
    g, pairs = _groups(spark, sf_dir)
    return g.expanded(X.build_features(g.groups, pairs))


@query()
def baseline_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, pairs = _groups(spark, sf_dir)
    return g.expanded(X.baseline_score(X.build_features(g.groups, pairs)).select("id_1", "id_2", "score"))


@query(f"{ALL} select id_1, id_2, label from scored")
def label_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir)
    return E.label_pairs(_candidates(records), _truth(records)).select("id_1", "id_2", "label")


@query(f"with {RECORDS}, listed as (select id_1 as anchor, string_agg(id_2, ',') as matches from truth group by id_1), each as (select anchor, unnest(string_split(matches, ',')) as m from listed) select least(anchor, m) as id_1, greatest(anchor, m) as id_2 from each")
def explode_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List-form truth, as a ground-truth file has it, back to pairs."""
    listed = _truth(_records(spark, sf_dir)).groupBy(F.col("id_1").alias("anchor")).agg(F.array_join(F.collect_set("id_2"), ",").alias("matches"))
    return E.explode_matches(listed)


@query()
def train_gbt_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees fitted on every labelled candidate, and their scores of the same. Equal rows are one row of their number as weight."""
    g, pairs = _groups(spark, sf_dir)
    features = written(X.build_features(g.groups, pairs), "features")
    rows = written(g.counted(features).groupBy(*X.FEATURES, "label").agg(F.sum("n").cast("double").alias("weight")), "rows")
    scored = M.PairModel({"maxIter": 20}).fit(rows, weight="weight").predict(features)
    return g.expanded(scored.select("id_1", "id_2", "score"), label=True).select("id_1", "id_2", "label", "score")


# decision ------------------------------------------------------------------------

_F = "case when 0.25 * p + r > 0 then 1.25 * p * r / (0.25 * p + r) else 0 end"
_PR = "case when tp + fp > 0 then tp / (tp + fp)::double else 0 end as p, case when tp + fn > 0 then tp / (tp + fn)::double else 0 end as r"


@query(
    f"""{ALL}, g as (select 0.01::double + i * (0.98::double / 99) as threshold from range(100) t(i)),
    c as (select threshold, count(*) filter (label = 1 and score >= threshold) as tp, count(*) filter (label = 0 and score >= threshold) as fp, count(*) filter (label = 1 and score < threshold) as fn from g, scored group by threshold),
    m as (select *, {_PR} from c)
    select round(threshold, 6) as threshold, tp as true_positives, fp as false_positives, fn as false_negatives, round({_F}, 6) as f_beta from m"""
)
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, pairs = _groups(spark, sf_dir)
    out = D.sweep(g.counted(_group_scores(g, pairs)), weight="n")
    return out.select(_r6("threshold"), "true_positives", "false_positives", "false_negatives", _r6("f_beta"))


@query(f"{ALL}, c as (select count(*) filter (label = 1 and score >= 0.5) as tp, count(*) filter (label = 0 and score >= 0.5) as fp, count(*) filter (label = 1 and score < 0.5) as fn from scored), m as (select *, {_PR} from c) select tp as true_positives, fp as false_positives, fn as false_negatives, round({_F}, 6) as f_beta from m")
def f_beta(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, pairs = _groups(spark, sf_dir)
    out = D.f_beta_score(g.counted(_group_scores(g, pairs)).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")), weight="n")
    return out.select("true_positives", "false_positives", "false_negatives", _r6("f_beta"))


@query(f"{ALL} select record_id as source1_entity_id, coalesce(string_agg(id_2, ',' order by id_2), '') as matched_entity_ids from anchors left join (select * from scored where score >= 0.5) on id_1 = record_id group by record_id")
def assemble_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, pairs = _groups(spark, sf_dir)
    return g.lists(_group_scores(g, pairs).where(F.col("score") >= THRESHOLD), "matched_entity_ids")


@query(f"{ALL} select record_id from anchors where record_id not in (select id_1 from scored where score >= 0.5)")
def singletons(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, pairs = _groups(spark, sf_dir)
    matched = _group_scores(g, pairs).where(F.col("score") >= THRESHOLD).select(F.col("id_1").alias("group"))
    return g.members(True).join(matched.distinct(), "group", "left_anti").select("record_id")


# evaluation and checks -----------------------------------------------------------


@query(f"{ALL}, pred as (select id_1, id_2 from scored where score >= 0.5), c as (select (select count(*) from (select * from pred intersect select * from truth)) as tp, (select count(*) from (select * from pred except select * from truth)) as fp, (select count(*) from (select * from truth except select * from pred)) as fn), m as (select *, {_PR} from c) select round(p, 6) as precision, round(r, 6) as recall, round({_F}, 6) as f0_5, tp as true_positives, fp as false_positives, fn as false_negatives from m")
def match_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, pairs = _groups(spark, sf_dir)
    out = G.match_metrics(g, _group_scores(g, pairs).where(F.col("score") >= THRESHOLD))
    return out.select(_r6("precision"), _r6("recall"), _r6("f0_5"), "true_positives", "false_positives", "false_negatives")


@query(f"with {RECORDS}, {CANDIDATES}, n as (select count(*)::double as n from records) select round((select count(*) from (select * from candidates intersect select * from truth)) / (select count(*) from truth)::double, 6) as pair_completeness, round(1 - (select count(*) from candidates) / (n * (n - 1) / 2), 6) as reduction_ratio, (select count(*) from candidates)::double as candidate_count, (select count(*) from truth)::double as true_match_count, (select count(*) from (select * from candidates intersect select * from truth))::double as matches_found from n where (select count(*) from truth) > 0")
def blocking_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir)
    g = G.grouped(records)
    out = G.blocking_metrics(g, G.retrieve(g), records.agg(F.count("*").alias("n")))
    return out.select(_r6("pair_completeness"), _r6("reduction_ratio"), "candidate_count", "true_match_count", "matches_found")


def _errors_sql(wrong: str, against: str) -> str:
    return f"{ALL}, pred as (select id_1, id_2 from scored where score >= 0.5), e as (select * from {wrong} except select * from {against}) select id_1, id_2, a.name as name_1, a.country as country_1, b.name as name_2, b.country as country_2 from e left join records a on a.record_id = id_1 left join records b on b.record_id = id_2"


@query(_errors_sql("pred", "truth"))
def false_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, pairs = _groups(spark, sf_dir)
    return g.expanded(G.with_names(g, _group_scores(g, pairs).where(F.col("score") >= THRESHOLD).select("id_1", "id_2").distinct()), label=True).where("label = 0").select(*E.ERRORS)


@query(_errors_sql("(select distinct a.record_id as id_1, b.record_id as id_2 from anchors a join targets b on a.address = b.address where a.address <> '')", "pred"))
def missed_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of one address, as the truth here, that the score of names and addresses does not accept."""
    g, pairs = _groups(spark, sf_dir)
    predicted = _group_scores(g, pairs).where(F.col("score") >= THRESHOLD).select("id_1", "id_2")
    missed = G.equal_values(g, "address", trimmed=False).distinct().join(predicted, ["id_1", "id_2"], "left_anti")
    return g.expanded(G.with_names(g, missed)).select(*E.ERRORS)


@query(
    f"""{ALL}, single as (select count(*) as n from anchors where record_id not in (select id_1 from scored where score >= 0.5)), a as (select count(*) as n from anchors)
    select 'blank lists allowed' as checked, a.n as rows, true as columns_ok, 0::bigint as nulls, true as valid from a
    union all select 'no blank lists', a.n, true, single.n::bigint, single.n = 0 from a, single
    union all select 'other columns', count(*), false, 0::bigint, false from scored
    union all select 'no rows', 0, true, 0::bigint, true"""
)
def validate_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of results of one row for each anchor: with blank lists allowed and not, with other columns, and empty."""
    g, pairs = _groups(spark, sf_dir)
    scored = written(_group_scores(g, pairs), "scored")
    lists = g.lists(scored.where(F.col("score") >= THRESHOLD), "matched_entity_ids")
    blank = lists.withColumn("matched_entity_ids", F.when(F.col("matched_entity_ids") != "", F.col("matched_entity_ids")))
    other = g.expanded(scored, label=True).select("id_1", "id_2", "score", "label")
    cases = [("blank lists allowed", V.findings(blank, V.RESULT, ["matched_entity_ids"])), ("no blank lists", V.findings(blank, V.RESULT)), ("other columns", V.findings(other, V.SCORED)), ("no rows", V.findings(lists.limit(0), V.RESULT))]
    return reduce(DataFrame.unionAll, [df.select(F.lit(name).alias("checked"), "*") for name, df in cases])


# files ---------------------------------------------------------------------------


@query("select 'S' || (doc_id % 3 + 1) || '-' || doc_id as record_id, text as name, source as address, case when doc_id % 4 = 0 then '' else lang end as country from documents")
def tsv_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three source files of whole texts, line breaks and quotes included, written, read back under internal names and united."""
    docs = _table(spark, sf_dir, "documents").withColumn("k", F.col("doc_id") % 3 + 1)
    raw = docs.select("k", F.concat(F.lit("S"), F.col("k").cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"), F.col("text").alias("business_name"), F.col("source").alias("business_address"), F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("lang")).alias("country"))
    folder, frames = new_path(spark, "sources"), []
    for k in (1, 2, 3):
        tsv.write_tsv(raw.where(F.col("k") == k).drop("k"), f"{folder}/{k}.tsv")
        frames.append(tsv.require_columns(tsv.read_source(spark, f"{folder}/{k}.tsv"), f"source {k}", ["record_id", "name", "address", "country"]))
    return R.union_all(frames)


@query(f"with {RECORDS} select least(id_1, id_2) as id_1, greatest(id_1, id_2) as id_2 from truth")
def tsv_ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The truth as a file of lists, blank ones included, written, read by position and exploded."""
    records = _records(spark, sf_dir)
    path = new_path(spark, "truth")
    tsv.write_tsv(D.lists(_truth(records), sides(records)[0], "matches"), path)
    return E.explode_matches(tsv.read_ground_truth(spark, path))


@query(f"{ALL} select record_id as source1_entity_id, coalesce(string_agg(id_2, ',' order by id_2), '') as matched_entity_ids from anchors left join (select * from scored where score >= 0.5) on id_1 = record_id group by record_id")
def resumed_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of a run that stopped after some anchors, and of one that went on with the others."""
    g, pairs = _groups(spark, sf_dir)
    anchors, path = g.members(True), new_path(spark, "results")
    matched = written(_group_scores(g, pairs).where(F.col("score") >= THRESHOLD), "matched")
    tsv.write_tsv(g.lists(matched, "matched_entity_ids", anchors.where(F.crc32("record_id") % 2 == 0)), path)
    rest = written(D.remaining(anchors, tsv.read_source(spark, path)), "remaining")
    tsv.write_tsv(g.lists(matched, "matched_entity_ids", rest), path, mode="append")
    return tsv.read_source(spark, path)


@query(
    f"""{ALL}, g as (select 0.01::double + i * (0.98::double / 99) as threshold from range(100) t(i)),
    c as (select threshold, count(*) filter (label = 1 and score >= threshold) as tp, count(*) filter (label = 0 and score >= threshold) as fp, count(*) filter (label = 1 and score < threshold) as fn from g, scored group by threshold),
    m as (select *, {_PR} from c), f as (select threshold, {_F} as f from m)
    select round(threshold, 6) as threshold from f order by round(f, 9) desc, threshold limit 1"""
)
def tuned_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best threshold, saved with a model and loaded again."""
    folder = new_path(spark, "model")
    g, pairs = _groups(spark, sf_dir)
    M.save_threshold(spark, folder, *D.best_threshold(g.counted(_group_scores(g, pairs)), weight="n"))
    return spark.createDataFrame([(M.load_threshold(spark, folder),)], "threshold double").select(_r6("threshold"))
