"""Registered queries of this package: each maps the given tables to record fields and the results back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    align,
    bpe,
    class_lm,
    decontaminate,
    language,
    merkle,
    near_dup,
    pii,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def records(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` as decision records: the id is the row order, the text the description."""
    return as_records(spark.read.parquet(f"{sf}/documents.parquet"))


def as_records(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("row_ord"), F.col("text").alias("desc"), "lang", "source")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def back(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("row_ord", "doc_id")


@query
def op1_sharding(spark, sf):
    return back(sharding.shard_records(records(spark, sf), n_shards=24))


@query
def op2_bpe(spark, sf):
    return back(bpe.token_digests(records(spark, sf), vocabulary()))


@query
def op4_quality_rules(spark, sf):
    return back(quality_rules.rate_records(records(spark, sf)))


def _rules_sql() -> str:
    """The same thresholds in DuckDB SQL, written from the rule table."""

    def ok(r: quality_rules.Rule) -> str:
        of = quality_rules.RATIOS[r.measure]
        v = f"({of[0]}::DOUBLE / nullif({of[1]}, 0)::DOUBLE)"
        both = [f"{v} >= {r.low}::DOUBLE"] * (r.low is not None) + [f"{v} <= {r.high}::DOUBLE"] * (r.high is not None)
        return f"(coalesce({' AND '.join(both)}, true) OR n_words < {r.from_words})"

    stops = ", ".join(f"'{w}'" for w in sorted({w for ws in quality_rules.STOP_WORDS.values() for w in ws}))
    word = r"[^\x20\x09-\x0D]"
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '{word}+') AS ws,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) AS ls FROM d),
    g AS (SELECT rid, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3] || ' ' || ws[i+4] AS run
          FROM w, unnest(range(1, len(ws) - 3)) u(i)),
    twice AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, run) > 1),
    covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(5) r(k) GROUP BY rid),
    m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
                 length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                 (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
                 len(ls) AS n_lines, length(t) - length(replace(t, '!', '')) AS n_shouts,
                 len(list_filter(ws, lambda x: lower(rtrim(x, '.,;:!?')) IN ({stops}))) AS n_stop_words,
                 len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i-1])) AS n_stutters
          FROM w LEFT JOIN covered USING (rid)),
    f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND {" AND ".join(map(ok, quality_rules.RULES))} AS kept
    FROM f"""


ORACLES["op4_quality_rules"] = _rules_sql()


@query
def op8_simhash_near_dedup(spark, sf):
    return back(near_dup.near_copies(records(spark, sf)))


@query
def op9_decontamination(spark, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").alias("row_ord"), F.col("text").alias("desc"))
    return back(decontaminate.contaminated_records(records(spark, sf), items))


ORACLES["op9_decontamination"] = r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
               FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
               FROM benchmark),
    w AS (SELECT DISTINCT item_id, least(len(ws), 10) AS wide,
                 array_to_string(list_slice(ws, i, i + least(len(ws), 10) - 1), ' ') AS run
          FROM b, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) u(i) WHERE len(ws) > 0),
    g AS (SELECT rid, i, wide, array_to_string(list_slice(ws, i, i + wide - 1), ' ') AS run
          FROM d, (SELECT DISTINCT wide FROM w) k, unnest(range(1, len(ws) - wide + 2)) u(i)),
    h AS (SELECT rid, i, g.wide, item_id FROM g JOIN w ON g.wide = w.wide AND g.run = w.run),
    p AS (SELECT rid, count(DISTINCT i + k) AS n_hit FROM h, unnest(range(wide)) r(k) GROUP BY rid),
    t AS (SELECT rid, count(DISTINCT item_id) AS n_items,
                 sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
          FROM h GROUP BY rid),
    k AS (SELECT rid, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS term FROM d),
    c AS (SELECT term, count(*) AS n FROM k GROUP BY term),
    v AS (SELECT DISTINCT run, wide FROM w),
    q AS (SELECT run, wide, off, x.term, row_number() OVER (PARTITION BY run, wide ORDER BY n, off) AS nth,
                 count(*) OVER (PARTITION BY run, wide) AS present
          FROM (SELECT run, wide, unnest(range(wide)) AS off, unnest(string_split(run, ' ')) AS term FROM v) x JOIN c USING (term)),
    a AS (SELECT run, wide, min(off) AS off, arg_min(term, off) AS one, arg_max(term, off) AS two, max(off) - min(off) AS gap
          FROM q WHERE nth <= 2 AND present >= 0.8 * wide GROUP BY run, wide),
    m AS (SELECT DISTINCT x.rid, x.pos - off AS start, run, wide
          FROM a JOIN k x ON x.term = one JOIN k y ON y.rid = x.rid AND y.term = two
          WHERE wide = 1 OR y.pos - x.pos BETWEEN greatest(gap - 2, 1) AND gap + 2),
    e AS (SELECT rid, run, wide FROM m JOIN d USING (rid), unnest(range(wide)) u(i)
          WHERE list_contains(list_slice(ws, greatest(start + i - 2, 1), greatest(start + i + 2, 0)), string_split(run, ' ')[i + 1])
          GROUP BY rid, start, run, wide HAVING count(*) >= 0.8 * wide),
    n AS (SELECT rid, count(DISTINCT item_id) AS n_near FROM e JOIN w USING (run, wide) GROUP BY rid)
    SELECT doc_id, coalesce(n_near, 0)::BIGINT AS n_near, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN p USING (rid) LEFT JOIN t USING (rid) LEFT JOIN n USING (rid)"""


@query
def op10_pii(spark, sf):
    return back(pii.personal_data(records(spark, sf)).drop("dhash").withColumn("spans", pii.joined(F.col("spans"))))


@query
def op3_toxicity(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").select(F.col("doc_id").alias("row_ord"), "toxic")
    return back(toxicity.score_toxicity(records(spark, sf), labels))


@query
def op7_secret_scan(spark, sf):
    d = secret_scan.find_secrets(records(spark, sf))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in secret_scan.KINDS]
    base, spans = (pii.joined(F.col(c)) for c in ("base", "spans"))
    return back(d.select("row_ord", *counts, F.sha2(base, 256).alias("base_sha256"), spans.alias("spans")))


@query
def op6_lm_scoring(spark, sf):
    return back(class_lm.score_texts(records(spark, sf)))


@query
def op5_quality_classifier(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").select(F.col("doc_id").alias("row_ord"), "quality")
    news = records(spark, sf).select("row_ord", F.col("desc").alias("snippet"), "lang")
    return back(quality_classifier.classify_news(news, labels))


@query
def op11_token_alignment(spark, sf):
    return back(align.align_records(records(spark, sf), vocabulary(), vocabulary("piece_bpe_32k.model")))


#: Levels that the SQL below spells out: 8^8 rows of a language, 8^3 languages.
LEVELS, SHELF_LEVELS = 8, 3


@query
def op12_merkle_manifest(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    news = docs.select(F.col("doc_id").alias("row_ord"), F.col("source").alias("name"), "lang", F.col("n_chars").alias("sig"), F.col("text").alias("snippet"))
    third = F.crc32(F.col("row_ord").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("snippet", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    told = merkle.news_manifest(news, received={"snippet": F.when(third, lower).otherwise(F.col("snippet"))})
    return back(told.drop("path"))


def _manifest_sql() -> str:
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"

    def digest(text: str) -> str:
        return f"sha256({' || '.join(map(field, ['doc_id', 'source', 'lang', 'n_chars', text]))})"

    def levels(t: str, n: int) -> str:
        return ",\n".join(
            f"""{t}r{k} AS (SELECT tree, pos // 8 AS run, list(hash ORDER BY pos) AS kids, any_value(size) AS size FROM {t}{k} GROUP BY ALL),
    {t}{k + 1} AS (SELECT tree, run AS pos, (size + 7) // 8 AS size,
                 CASE WHEN size = 1 THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS hash FROM {t}r{k})"""
            for k in range(n)
        )

    def folds(f: str, t: str, n: int, on: str, pos: str) -> str:
        """Steps that fold one level each into ``folded`` and ``proof``."""
        out = []
        for k in range(n):
            at = f"(({pos} // {8**k}) % 8)"
            left, right = f"array_to_string(r.kids[1:{at}], '')", f"array_to_string(r.kids[{at} + 2:], '')"
            out.append(
                f"""{f}{k + 1} AS (SELECT f.* REPLACE (CASE WHEN r.size > 1 THEN sha256({left} || folded || {right}) ELSE folded END AS folded,
                 CASE WHEN r.size > 1 THEN proof || {left} || {right} ELSE proof END AS proof)
            FROM {f}{k} f JOIN {t}r{k} r ON r.tree = {on} AND r.run = {pos} // {8 ** (k + 1)})"""
            )
        return ",\n".join(out)

    bit = "CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END"
    byte = f"list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: {bit})"
    letters = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {letters}), lambda c, x: {byte}), 4294967295)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH d AS (SELECT *, CASE WHEN {crc} % 3 = 0 THEN {lower} ELSE text END AS told FROM documents),
    l AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {digest("text")} AS leaf, {digest("told")} AS folded FROM d),
    p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS size FROM l),
    t0 AS (SELECT tree, pos, size, leaf AS hash FROM p),
    {levels("t", LEVELS)},
    u0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS size, hash, tree AS shelf FROM t{LEVELS}),
    {levels("u", SHELF_LEVELS)},
    f0 AS (SELECT p.*, '' AS proof, u0.pos AS upos, u0.hash AS subroot FROM p JOIN u0 ON p.tree = u0.shelf),
    {folds("f", "t", LEVELS, "f.tree", "f.pos")},
    g0 AS (SELECT * FROM f{LEVELS}),
    {folds("g", "u", SHELF_LEVELS, "''", "f.upos")}
    SELECT doc_id, leaf, subroot, u{SHELF_LEVELS}.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
           folded = u{SHELF_LEVELS}.hash AS verified
    FROM g{SHELF_LEVELS}, u{SHELF_LEVELS}"""


ORACLES["op12_merkle_manifest"] = _manifest_sql()


@query
def op13_language_id(spark, sf):
    return back(language.news_languages(records(spark, sf).select("row_ord", F.col("desc").alias("snippet"), "lang")))
