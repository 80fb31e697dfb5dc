"""Secret scan: fixed patterns, and character Markov models for what they miss.

The patterns find assignments of passwords and tokens, access keys and long hexadecimal
strings. Any other run of 16 or more key-like characters is scored by two first-order
Markov models, of random strings and of ordinary identifiers; it is a span of kind
"random" if the log-likelihood ratio over its characters reaches ``MIN_RATIO``. Both
models are counted from labelled samples: values that the patterns find are random
strings, other words of six or more key-like characters are identifiers. Half of the
random model is uniform, so that strings in alphabets that the sample lacks stand out too.

Everything runs as DataFrame expressions. Positions come from the lengths of what lies
between matches, summed in a window for each document, after one shuffle of the matches.

Null and empty texts have no spans. Repeated rows are scanned as often as they occur. A
match in a long text costs the same as in a short one. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortal.llm.columns import hashed_sample, shielded, whole_text

# Fixed patterns. A match counts only if its value is long enough, see ``found_spans``.
ASSIGN = (
    r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KEY_LIKE = "A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![{KEY_LIKE}])[{KEY_LIKE}]{{16,}}"
IDENTIFIER = rf"(?<![{KEY_LIKE}])[{KEY_LIKE}]{{6,}}"
KINDS = ("assign", "access", "hex", "random")
PATTERNS = (ASSIGN, ACCESS, HEX, CANDIDATE)
MIN_ASSIGN_VALUE = 6

MOST_DOCUMENTS = 2_000
MIN_RATIO = 12.0
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(ALPHABET) + 1  # 0 stands for any other character


def _codes(text: Column) -> Column:
    return F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def _steps(text: Column) -> Column:
    """A number for each pair of neighbouring characters."""
    codes = _codes(text)
    n = F.greatest(F.size(codes) - 1, F.lit(0))
    return F.zip_with(F.slice(codes, 1, n), F.slice(codes, 2, n), lambda a, b: a * SIZE + b)


def labelled_strings(docs: DataFrame, most: int = MOST_DOCUMENTS) -> DataFrame:
    """``value`` and ``random`` from the ``most`` documents of the lowest hashes."""
    text = F.col("text")
    sample = hashed_sample(docs.select("text").where("text IS NOT NULL"), "text", most)
    values = F.concat(
        F.filter(
            F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)),
            lambda v: F.length(v) >= MIN_ASSIGN_VALUE,
        ),
        F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
    )
    rest = text
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    words = F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))
    both = F.array(
        F.struct(F.lit(True).alias("random"), values.alias("values")),
        F.struct(F.lit(False).alias("random"), words.alias("values")),
    )
    rows = sample.select(F.explode(both).alias("s"))
    return rows.select("s.random", F.explode("s.values").alias("value"))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each step from character to character, random over not.

    ``samples`` has ``value`` and ``random``. One row for each kind of step is collected.
    """
    counted = (
        samples.groupBy("random", "value")
        .count()
        .select("random", "count", F.explode(_steps(F.col("value"))).alias("step"))
        .groupBy("random", "step")
        .agg(F.sum("count").alias("n"))
        .collect()
    )
    counts = {True: [0.0] * SIZE**2, False: [0.0] * SIZE**2}
    for r in counted:
        counts[r["random"]][r["step"]] += r["n"]
    table = []
    for a in range(SIZE):
        row = slice(a * SIZE, (a + 1) * SIZE)
        total = {k: sum(c[row]) for k, c in counts.items()}
        for b in range(SIZE):
            at = a * SIZE + b
            random = (counts[True][at] + 1 / SIZE) / (total[True] + 1)
            plain = (counts[False][at] + 1 / SIZE) / (total[False] + 1)
            table.append(math.log((random + 1 / SIZE) / 2) - math.log(plain))
    return table


def ratio(text: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a string under the two models."""
    text_table = ",".join(f"{x:.6f}" for x in table)
    values = F.split(F.lit(text_table), ",").cast("array<double>")
    scores = F.transform(_steps(text), lambda s: F.get(values, s))
    return F.aggregate(scores, F.lit(0.0), lambda total, s: total + s)


def _matches(kind: int) -> Column:
    """Each match with its place in the list and the characters skipped before it."""
    pattern, text = PATTERNS[kind], F.col("text")
    found = F.col(f"_found{kind}")
    gaps = F.when(F.size(found) > 0, F.split(text, pattern, -1))
    return F.when(
        F.size(found) > 0,
        F.zip_with(
            F.sequence(F.lit(1), F.size(found)),
            found,
            lambda i, m: F.struct(
                F.lit(kind).alias("kind"),
                i.alias("place"),
                F.length(F.element_at(gaps, i)).alias("skipped"),
                m.alias("match"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<kind:int,place:int,skipped:int,match:string>>"))


def found_spans(docs: DataFrame, table: list[float]) -> DataFrame:
    """Every match of every document: its columns but the text, ``row``, ``kind`` (an
    index), ``start``, ``end`` (code points, end exclusive), ``match`` and ``ok``.

    A document without a match has one row with nulls. ``ok`` tells the spans from matches
    that fail: short values, candidates the models call ordinary, and candidates that
    overlap a span of a fixed pattern.
    """
    own = ["kind", "place", "skipped", "match", "row", "start", "end", "ok"]
    docs = docs.drop(*own)
    columns = [c for c in docs.columns if c != "text"]
    rows = (
        docs.withColumns({"text": whole_text(), "row": F.monotonically_increasing_id()})
        .withColumns(
            {
                f"_found{k}": F.regexp_extract_all("text", F.lit(p), F.lit(0))
                for k, p in enumerate(PATTERNS)
            }
        )
        .withColumn("_m", F.concat(*[_matches(k) for k in range(len(PATTERNS))]))
        .select(*columns, "row", F.explode_outer("_m").alias("_m"))
        .select(*columns, "row", "_m.*")
        .repartition("row")
    )
    upto = Window.partitionBy("row", "kind").orderBy("place")
    length = F.length("match")
    placed = rows.withColumn("end", F.sum(F.col("skipped") + length).over(upto)).withColumn(
        "start", F.col("end") - length
    )
    value = F.regexp_extract("match", ASSIGN, 1)
    kind = F.col("kind")
    own_ok = (
        F.when(kind == 0, F.length(value) >= MIN_ASSIGN_VALUE)
        .when(kind == 3, ratio(F.col("match"), table) >= MIN_RATIO)
        .otherwise(kind.isNotNull())
    )
    judged = placed.withColumn("ok", own_ok)
    base = F.col("ok") & (kind < 3)
    by_start = Window.partitionBy("row").orderBy("start", "kind")
    before = F.max(F.when(base, F.col("end"))).over(
        by_start.rowsBetween(Window.unboundedPreceding, -1)
    )
    after = F.min(F.when(base, F.col("start"))).over(
        by_start.rowsBetween(1, Window.unboundedFollowing)
    )
    free = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (
        F.coalesce(after, F.col("end")) >= F.col("end")
    )
    return (
        judged.withColumn("_free", free)
        .withColumn("ok", F.col("ok") & ((kind < 3) | F.col("_free")))
        .select(*columns, "row", "kind", "start", "end", "match", "ok")
    )


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def scan(docs: DataFrame, table: list[float]) -> DataFrame:
    """One row per document: its columns but the text, the number of spans of each fixed
    kind and of ``random`` ones, a digest of the former and a list of all.

    Columns of ``docs`` with the names of results are replaced; all others stay.
    """
    return shielded(docs, ["text"], lambda own: _scan(own, table))


def _scan(docs: DataFrame, table: list[float]) -> DataFrame:
    found = found_spans(docs, table)
    columns = [c for c in found.columns if c not in ("kind", "start", "end", "match", "ok")]
    span = F.when(F.col("ok"), F.struct("start", "kind", "end"))
    number = {
        f"n_{name}": F.count_if(F.col("ok") & (F.col("kind") == k)).alias(f"n_{name}")
        for k, name in enumerate(KINDS)
    }
    grouped = found.groupBy(*columns).agg(
        *number.values(), F.array_sort(F.collect_list(span)).alias("_spans")
    )
    base = F.filter("_spans", lambda s: s["kind"] < 3)
    return grouped.withColumns(
        {"base_sha256": F.sha2(_joined(base), 256), "spans": _joined(F.col("_spans"))}
    ).drop("_spans", "row")
