"""Codes as numbers in the codes' own order.

A first or last (date, code) is a minimum or maximum over a pair, which Spark can only
aggregate by sorting the raw events. With codes numbered in their order, date and number
make one long that sorts like the pair, and minima and maxima of longs run in a hash
aggregate. A set of numbers is a few longs of bits, which merge by ``or`` on the map side:
however many events a person has, a map task sends that person one row of fixed size.

There are two numberings. ``CodeDictionary`` ranks the codes that occur; it holds sets too.
``ShortCodes`` needs no table and no look-up: codes declared to have at most five ASCII
characters are numbers already.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortal.operators.joins import lookup_join
from cohortal.sources.tables import stage

# Up to so many codes are held as a literal of the plan; beyond, they are a written table.
LITERAL_CODES = 4096
# Up to so many, they are looked up in a literal map instead of a broadcast table.
MAPPED_CODES = 128
BITS = 63
# A set of a larger dictionary is sent as a list of the numbers it holds.
SET_WORDS = 4
# The day of an event without a date: it sorts before every date, which all have 23 bits.
NO_DAY = -(2**23)
# Bits of a code's number below its date.
NUMBER_BITS = 35
_LOW = 2**NUMBER_BITS - 1
_SEPARATOR = "\x01"
CHARACTERS = NUMBER_BITS // 7


class ShortCodes:
    """Codes of at most ``CHARACTERS`` ASCII characters as numbers, 7 bits a character.

    Shorter codes are filled up with zeros, so numbers sort like codes. Any other code is an
    error; 0 stands for a null code. The empty code cannot be told from it and is an error.
    """

    codes = None

    def number(self, df: DataFrame, code: str) -> DataFrame:
        text = F.col(f"`{code}`")
        number = F.lit(0).cast("bigint")
        for i in range(CHARACTERS):
            number = number * 128 + F.ascii(F.substring(text, i + 1, 1))
        fits = (F.octet_length(text) <= CHARACTERS) & (text != "") & (F.length(text) == F.octet_length(text))
        long = F.concat(F.lit("not a short code: "), text)
        number = F.when(text.isNull(), F.lit(0)).when(fits, number).otherwise(
            F.raise_error(long).cast("bigint")
        )
        return df.withColumn("_number", number)

    def decode(self, number: Column) -> Column:
        letters = []
        for i in reversed(range(CHARACTERS)):
            letter = F.call_function("shiftright", number, F.lit(7 * i)).bitwiseAND(F.lit(127))
            letters.append(F.when(letter > 0, F.char(letter)).otherwise(F.lit("")))
        return F.when(number > 0, F.concat(*letters))


@dataclass(frozen=True)
class CodeDictionary:
    """Distinct codes, numbered from 1 in their order; 0 stands for a null code.

    ``codes`` lists them if they are few. Else ``table`` holds (``_code``, ``_number``).
    """

    spark: SparkSession
    codes: list[str] | None
    numbered: DataFrame | None = None

    @cached_property
    def table(self) -> DataFrame:
        if self.codes is None:
            return self.numbered
        rows = self.spark.range(1).select(F.posexplode(self._literal).alias("_place", "_code"))
        return rows.select("_code", (F.col("_place") + 1).alias("_number"))

    @property
    def _literal(self) -> Column:
        return _text_array(self.codes)

    @property
    def n_words(self) -> int:
        """Longs that hold a set of the codes."""
        return -(-len(self.codes) // BITS)

    def number(self, df: DataFrame, code: str) -> DataFrame:
        """The rows with ``_number`` of their code. A code that the dictionary lacks is an
        error: it must not vanish from a first, a last or a set."""
        text = F.col(f"`{code}`")
        if self.codes is None:
            joined, known = lookup_join(df, self.table, code, "_code"), F.col("_number")
        elif not self.codes:
            joined, known = df, F.lit(None).cast("int")
        elif len(self.codes) <= MAPPED_CODES:
            numbers = F.sequence(F.lit(1), F.lit(len(self.codes)))
            joined, known = df, F.map_from_arrays(self._literal, numbers)[text]
        else:
            # At most LITERAL_CODES rows.
            joined = df.join(F.broadcast(self.table), text == F.col("_code"), "left")
            known = F.col("_number")
        lost = F.concat(F.lit("not in the code dictionary: "), text)
        number = F.when(text.isNull(), F.lit(0)).otherwise(
            F.coalesce(known, F.raise_error(lost).cast("int"))
        )
        return joined.select(*[F.col(f"`{c}`") for c in df.columns], number.alias("_number"))

    def decode(self, number: Column) -> Column:
        """The code of a number, where the dictionary is a literal."""
        return F.get(self._literal, number.cast("int") - 1)

    def set_words(self, number: Column) -> list[Column]:
        """Aggregates that hold the set of numbers, 63 to a long."""
        place = number - 1
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % BITS).cast("int"))
        return [
            F.coalesce(F.bit_or(F.when((place >= 0) & (F.floor(place / BITS) == k), bit)), F.lit(0))
            for k in range(self.n_words)
        ]

    def decode_set(self, words: list[Column]) -> Column:
        """The codes of a set, sorted. Only the places of words with a bit are looked at."""
        empty = F.array().cast("array<string>")
        if not words:
            return empty

        def of_word(k: int, word: Column) -> Column:
            codes = _text_array(self.codes[k * BITS : (k + 1) * BITS])
            held = F.transform(codes, lambda c, i: F.when(F.getbit(word, i) == 1, c))
            return F.when(word == 0, empty).otherwise(F.array_compact(held))

        return F.flatten(F.array(*[of_word(k, w) for k, w in enumerate(words)]))


def _text_array(texts: list[str]) -> Column:
    """The texts as one literal; Spark folds the split when it plans."""
    if not texts:
        return F.array().cast("array<string>")
    return F.split(F.lit(_SEPARATOR.join(texts)), _SEPARATOR)


def code_dictionary(df: DataFrame, code: str) -> CodeDictionary:
    """Dictionary of a column's codes; nulls are left out.

    Codes are sorted by their UTF-8 bytes, as Spark sorts text. Of more than
    ``LITERAL_CODES`` codes only one more than that reaches the driver; they are then sorted
    over range partitions and numbered by their place in a partition and its start.
    """
    spark = df.sparkSession
    distinct = df.select(F.col(code).alias("_code")).where(F.col(code).isNotNull()).distinct()
    found = [r[0] for r in distinct.limit(LITERAL_CODES + 1).collect()]
    if len(found) <= LITERAL_CODES and not any(_SEPARATOR in c for c in found):
        return CodeDictionary(spark, sorted(found, key=lambda c: c.encode()))
    # The partitions are cut once and written with their numbers.
    ranged = distinct.repartitionByRange(F.col("_code"))
    parts = stage(ranged.select("_code", F.spark_partition_id().alias("part")), "codes")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    starts = starts.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("_code"))
    numbered = parts.withColumn("place", place).join(F.broadcast(starts), "part")
    numbered = numbered.select("_code", (F.col("start") + F.col("place")).cast("int").alias("_number"))
    return CodeDictionary(spark, None, stage(numbered, "code_numbers"))


def packed(time: str) -> Column:
    """Date and ``_number`` of a row as one long that sorts like the two."""
    day = F.coalesce(F.unix_date(F.col(f"`{time}`")), F.lit(NO_DAY)).cast("bigint")
    return F.call_function("shiftleft", day, F.lit(NUMBER_BITS)) + F.col("_number")


def _date(packed: str) -> Column:
    day = F.call_function("shiftright", F.col(packed), F.lit(NUMBER_BITS)).cast("int")
    return F.when(day != NO_DAY, F.date_from_unix_date(day))


def _number(packed: str) -> Column:
    return F.col(packed).bitwiseAND(F.lit(_LOW))


def unpacked(column: str, dictionary: CodeDictionary | ShortCodes) -> Column:
    """(date, code) of a packed long, where numbers are decoded without a table."""
    return F.struct(
        _date(column).alias("date"), dictionary.decode(_number(column)).alias("code")
    )


def packable(df: DataFrame, *times: str) -> bool:
    """Dates fit one long together with a code number; timestamps do not."""
    return all(isinstance(df.schema[t].dataType, T.DateType) for t in times)


def packed_ends(
    df: DataFrame,
    keys: list[str],
    dictionary: CodeDictionary | ShortCodes,
    *,
    first: str,
    last: str,
    code: str,
    with_codes: bool = False,
) -> DataFrame:
    """Per keys: ``first`` and ``last`` as (date, code), and the sorted set of ``codes``.

    One hash aggregate and one shuffle. Nulls sort first, as in an ascending sort of the rows.
    """
    rows = dictionary.number(df, code)
    words = dictionary.set_words(F.col("_number")) if with_codes else []
    out = rows.groupBy(*keys).agg(
        F.min(packed(first)).alias("_first"),
        F.max(packed(last)).alias("_last"),
        *[w.alias(f"_word{k}") for k, w in enumerate(words)],
    )
    ends = []
    for end in ("_first", "_last"):
        if dictionary.codes is not None or isinstance(dictionary, ShortCodes):
            ends.append(unpacked(end, dictionary).alias(end[1:]))
            continue
        table = dictionary.table.toDF(f"{end}_code", f"{end}_known")
        numbered = out.withColumn(f"{end}_at", _number(end))
        out = lookup_join(numbered, table, f"{end}_at", f"{end}_known")
        ends.append(F.struct(_date(end).alias("date"), F.col(f"{end}_code").alias("code")).alias(end[1:]))
    if with_codes:
        ends.append(dictionary.decode_set([F.col(f"_word{k}") for k in range(len(words))]).alias("codes"))
    return out.select(*[F.col(f"`{k}`") for k in keys], *ends)


def code_sets(df: DataFrame, keys: list[str], dictionary: CodeDictionary, code: str, name: str) -> DataFrame:
    """Sorted set of codes per keys, in one shuffle.

    Sets merge on the map side, as bits or, of a larger dictionary, as lists of numbers. What
    a reducer holds of a key is at most the whole dictionary, however many events it has.
    """
    rows = dictionary.number(df, code)
    named = [F.col(f"`{k}`") for k in keys]
    if dictionary.n_words > SET_WORDS:
        held = F.collect_set(F.when(F.col("_number") > 0, F.col("_number")))
        out = rows.groupBy(*keys).agg(F.array_sort(held).alias("_held"))
        return out.select(*named, F.transform("_held", dictionary.decode).alias(name))
    words = dictionary.set_words(F.col("_number"))
    out = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[w.alias(f"_word{k}") for k, w in enumerate(words)]
    )
    found = dictionary.decode_set([F.col(f"_word{k}") for k in range(len(words))])
    return out.select(*named, found.alias(name))
