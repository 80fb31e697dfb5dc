"""Queries of the text operators over the driver tables, with checking SQL where it exists."""

from __future__ import annotations

import zlib
from functools import wraps

import public_tokenizers
from pyspark.sql import functions as F

from cohortal.llm import (
    exact_dedup,
    html_text,
    langid,
    lexical_search,
    line_dedup,
    mixing,
    near_dedup,
    ordinal,
    packing,
    periodic_runs,
    pipeline,
    quality,
    secrets,
    suffix_dedup,
)
from cohortal.llm.workers import importable

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark, sf):
            importable(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark, sf: str, name: str):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_ordinal_quality")
def op1(spark, sf):
    docs = table(spark, sf, "documents")
    model = ordinal.train(docs, ordinal.driver_ratings(table(spark, sf, "labels")))
    graded = ordinal.grade(docs.select("doc_id", "text"), model)
    return graded.select("doc_id", "expected_grade", "tail_probability", "kept")


@query("op2_byte_gru_language")
def op2(spark, sf):
    docs = table(spark, sf, "documents")
    net = langid.train(docs, ~langid.held_out())
    found = langid.identify(docs.select("doc_id", "text"), net)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query("op4_markov_secrets")
def op4(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return secrets.scan(docs, secrets.train(secrets.labelled_strings(docs)))


@query("op5_html_layout_text")
def op5(spark, sf):
    return html_text.extract(table(spark, sf, "pages")).select("page_id", "text")


@query("op6_quality_rules")
def op6(spark, sf):
    docs = table(spark, sf, "documents")
    model = quality.train(docs, table(spark, sf, "labels"))
    judged = quality.judge(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "probability", "kept")


@query("op3_best_fit_packing")
def op3(spark, sf):
    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    pieces = packing.pack(table(spark, sf, "documents"), *files)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query(
    "op7_exact_dedup",
    """
    WITH d AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS norm
        FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY norm)
    """,
)
def op7(spark, sf):
    groups = exact_dedup.exact_groups(table(spark, sf, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op8_hyperminhash_near_dedup")
def op8(spark, sf):
    found = near_dedup.near_components(table(spark, sf, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_source_mixing")
def op9(spark, sf):
    mixed = mixing.mix(table(spark, sf, "documents"))
    taken = mixing.taken_words(mixed)
    return taken.select("doc_id", "size", "source_size", "target", "taken")


@query("op10_suffix_dedup")
def op10(spark, sf):
    return suffix_dedup.remove_repeats(table(spark, sf, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(
    "op11_line_dedup",
    f"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
        FROM documents),
    l AS (
        SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
    k AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            '{_UPPER}', '{_LOWER}') AS key FROM l),
    s AS (
        SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE last <> doc_id) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                           FILTER (WHERE last IS NULL OR last = doc_id), '')) AS kept_sha256
    FROM k LEFT JOIN s ON k.key = s.key GROUP BY r, doc_id
    """,
)
def op11(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = line_dedup.drop_repeated_lines(docs)
    digest = F.sha2(F.col("kept_text"), 256).alias("kept_sha256")
    return out.select("doc_id", "n_lines", "n_dropped", digest)


def _terms(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    "op12_lexical_search",
    f"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, {_terms('text')} AS terms FROM documents),
    known AS (SELECT *, len(terms) AS n FROM d WHERE len(terms) > 0),
    total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM known),
    found AS (
        SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM known)
        GROUP BY r, term),
    weights AS (
        SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
        FROM found, total GROUP BY term, docs),
    asked AS (
        SELECT DISTINCT item_id, text, term
        FROM (SELECT item_id, text, unnest({_terms('text')}) AS term FROM benchmark)),
    scored AS (
        SELECT item_id, text, r, sum(w * ((1000000000 * tf)
            // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
        FROM asked JOIN found USING (term) JOIN weights USING (term)
            JOIN known USING (r), total
        GROUP BY item_id, text, r)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score
    FROM (SELECT item_id, doc_id, score, row_number() OVER (
                PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank
          FROM scored JOIN known USING (r) WHERE score > 0)
    WHERE rank <= 10
    """,
)
def op12(spark, sf):
    return lexical_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def with_planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Of one document in ten, by the checksum of its id, the words from some place on repeat
    with some period; a document without an id stays as it is."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@query("op13_periodic_runs")
def op13(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = periodic_runs.with_runs(docs, prepare=with_planted_period)
    longest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")
            ),
        )
    )
    rows = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    best = found.withColumn("best", longest)
    length, period = F.col("best.length"), -F.col("best.p")
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(rows, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("pipeline", pipeline.ORACLE_SQL)
def all_stages(spark, sf):
    return pipeline.run(spark, sf)
