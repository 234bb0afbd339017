"""Licence scan: canonical digest look-up of entire texts.

A text is normalised (case, copyright lines, equivalent spellings,
punctuation, white space), digested, and hash-joined to the digests of
known licence texts; all of it is Spark SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import KNOWN

# Equivalent spellings, applied to lower-cased words (fixed values).
SPELLINGS = [
    ("acknowledgment", "acknowledgement"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("copyright holder", "copyright owner"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("merchantibility", "merchantability"),
    ("modelled", "modeled"),
    ("noncommercial", "non commercial"),
    ("non-commercial", "non commercial"),
    ("organisation", "organization"),
    ("percent", "per cent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("recognise", "recognize"),
    ("sub-licence", "sublicense"),
    ("sub-license", "sublicense"),
    ("sublicence", "sublicense"),
    ("sublicenced", "sublicensed"),
    ("utilisation", "utilization"),
    ("while", "whilst"),
    ("wilful", "willful"),
]

# A line that states a copyright (lower case): a copyright word or sign at its
# start, behind any comment leader, then a sign, a year somewhere, or nothing
# but a name of a few words.  Words that go on a licence's own sentences where
# a line happens to break are no names.
LEAD = r"[^a-z0-9(©\n]*(?:(?:rem|dnl|portions)[ \t]+)?"
YEAR = r"[^\n]*\b(?:19|20)[0-9][0-9]\b[^\n]*"
NO_NAME = ("act and as by for has holder holders if in interest interests is law laws licence license may must no not notice notices of on or owner "
           "owners protection statement statements that the this to under which you your").split()
NAME = r"[ \t]+(?!(?:" + "|".join(NO_NAME) + r")\b)[^\s]+(?:[ \t]+[^\s]+){0,4}[ \t]*"
COPYRIGHT_LINE = (rf"(?md)^{LEAD}(?:copyright[ \t]*[,:]?[ \t]*(?:\(c\)|©|&copy;)[^\n]*|copyright\b{YEAR}|copyright:[^\n]*|copyright(?:[ \t]+by)?{NAME}"
                  rf"|\(c\)[ \t]*copyright[^\n]*|\(c\){YEAR}|\(c\){NAME}|(?:©|&copy;)[^\n]*)$")
RESERVED_LINE = r"(?md)^[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*$"


def with_digest(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the SHA-256 of the canonical form of a licence text: lower
    case; lines that state a copyright (``copyright``, ``(c)`` or the sign,
    then a year or a name) and ``all rights reserved`` removed; spellings
    unified; every run of other characters than a-z, 0-9 one blank; trimmed.

    The steps are columns of their own, so that each is computed once, and the
    costly ones only on texts that hold what they look for."""
    a, b, c = "__lower", "__stated", "__spelt"
    t = F.col(a)
    stated = F.regexp_replace(F.regexp_replace(t, r"\r", "\n"), COPYRIGHT_LINE, "")
    stated = F.regexp_replace(stated, RESERVED_LINE, "")
    claims = t.contains("copyright") | t.contains("(c)") | t.contains("©") | t.contains("&copy;") | t.contains("all rights reserved")
    df = df.withColumn(a, F.lower(F.coalesce(F.col(text), F.lit("")))).withColumn(b, F.when(claims, stated).otherwise(t))
    t = F.col(b)
    # one rule after the other, as data: thirty nested calls make too large a method
    rules = F.array(*[F.struct(F.lit(rf"\b{x}\b").alias("x"), F.lit(y).alias("y")) for x, y in SPELLINGS])
    spelt = F.aggregate(rules, F.regexp_replace(t, r"[ \t\n\r]+", " "), lambda acc, r: F.regexp_replace(acc, r["x"], r["y"]))
    # a spelling of several words may be parted by a line end: its longest word tells
    held = None
    for word in sorted({max(x.replace("-", " ").split(), key=len) for x, _ in SPELLINGS}):
        held = t.contains(word) if held is None else held | t.contains(word)
    df = df.withColumn(c, F.when(held, spelt).otherwise(t))
    canon = F.trim(F.regexp_replace(F.col(c), r"[^a-z0-9]+", " "))
    return df.withColumn(out, F.sha2(canon.cast("binary"), 256)).drop(a, b, c)


def canonical_sql(text: str) -> str:
    """The same canonical form in DuckDB, found another way: line by line, by
    the line's words."""
    words = r"regexp_extract_all(x, '\(c\)|©|&copy;|[a-z0-9]+')"
    plain = rf"list_filter({words}, lambda w: w NOT IN ('rem', 'dnl', 'portions') OR w <> {words}[1])"
    no_name = ", ".join(f"'{w}'" for w in NO_NAME)
    year = r"regexp_matches(x, '\b(19|20)[0-9][0-9]\b')"
    few = r"len(string_split_regex(trim(regexp_replace(x, '^.*?(copyright([ \t]+by)?|\(c\))', ''), ' ' || chr(9)), '[ \t]+')) <= 5"
    first = f"coalesce(w[CASE WHEN w[1] = 'copyright' AND w[2] = 'by' THEN 3 ELSE 2 END], '')"
    named = rf"({first} NOT IN ({no_name}) AND regexp_matches(x, '(copyright([ \t]+by)?|\(c\))[ \t]+[^ \t]') AND {few})"
    states = (f"list_any_value(list_transform([{plain}], lambda w: coalesce(w[1] IN ('©', '&copy;') "
              f"OR (w[1] = 'copyright' AND (w[2] IN ('(c)', '©', '&copy;') OR contains(x, 'copyright:') OR {year} OR {named})) "
              f"OR (w[1] = '(c)' AND (w[2] = 'copyright' OR {year} OR {named})), false)))")
    reserved = r"regexp_full_match(x, '[^a-z0-9]*all rights reserved[^a-z0-9]*')"
    t = rf"string_split(regexp_replace(lower(coalesce({text}, '')), '\r', chr(10), 'g'), chr(10))"
    t = f"array_to_string(list_filter({t}, lambda x: NOT {states} AND NOT {reserved}), chr(10))"
    t = rf"regexp_replace({t}, '[ \t\n\r]+', ' ', 'g')"
    for a, b in SPELLINGS:
        t = rf"regexp_replace({t}, '\b{a}\b', '{b}', 'g')"
    return f"trim(regexp_replace({t}, '[^a-z0-9]+', ' ', 'g'))"


def known_licenses(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """``license, digest`` of the known licence texts (a short fixed list)."""
    rows = spark.createDataFrame(texts if texts is not None else KNOWN, "license string, body string")
    return with_digest(rows, "body", "digest").groupBy("digest").agg(F.min("license").alias("license"))


def anchors(texts: list[tuple[str, str]] | None = None) -> list[str]:
    """For each known text its longest word that no spelling rule makes: a
    text whose lower-case form holds none of these cannot be any of them."""
    made = {w for _, y in SPELLINGS for w in y.split()} | {w for x, _ in SPELLINGS for w in x.replace("-", " ").split()}
    found = set()
    for _, body in texts if texts is not None else KNOWN:
        words = [w for w in re.findall(r"[a-z0-9]+", body.lower()) if w not in made]
        found.add(max(words, key=lambda w: (len(w), w)) if words else "")
    return sorted(found)


def scan(docs: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``canonical_digest`` and ``license`` (NULL: the entire
    text is no known licence).

    NULL reads as empty; a text that is empty once normalised (only
    punctuation or copyright lines) is no licence; repeated rows stay;
    input columns named like the outputs are replaced."""
    d = with_digest(docs.drop("canonical_digest", "license"), text, "canonical_digest")
    return d.join(F.broadcast(_look(known)), F.col("canonical_digest") == F.col("__digest"), "left").drop("__digest")


def scan_lines(docs: DataFrame, known: DataFrame, words: list[str], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, line_no, license`` of every line (from 1) that by itself is a
    known licence notice; other lines give no row.  Only texts and lines that
    hold one of the ``words`` (see :func:`anchors`) are normalised."""

    def may(x: Column) -> Column:
        low, any_of = F.lower(x), F.lit(False)
        for w in words:
            any_of = any_of | low.contains(w)
        return any_of

    lines = docs.filter(may(F.col(text))).select(F.col(id_col), F.posexplode(F.split(F.col(text), "\n")).alias("__p", "__line"))
    lines = with_digest(lines.filter(may(F.col("__line"))), "__line", "__d")
    return (lines.join(F.broadcast(_look(known)), F.col("__d") == F.col("__digest"))
            .select(id_col, (F.col("__p") + 1).alias("line_no"), "license"))


def _look(known: DataFrame) -> DataFrame:
    """The fixed list of known digests, without that of the empty text."""
    return known.filter(F.col("digest") != F.sha2(F.lit("").cast("binary"), 256)).select(
        F.col("digest").alias("__digest"), "license")
