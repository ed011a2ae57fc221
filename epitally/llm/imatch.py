"""I-Match fingerprints, in DataFrame functions only.

The lexicon has the terms found in at least one in ``RARE`` and at most one in ``COMMON`` of
all documents, a band of inverse document frequency. It is cut at random into ``SUBSETS``
parts. A text's fingerprint has one digest for each part: of the text's different terms in it,
sorted. Texts are alike as far as their digests agree, so a changed term costs the digest of
its own part only.

The lexicon is sent to all tasks. Its size does not grow with the number of documents: a term
of the band is in at least one of ``RARE`` documents, so there are at most ``RARE`` times as many
as a document has different terms on average.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.llm.common import ascii_lower, hash_pair, ranked, whole_text
from epitally.workspace import written

RARE = 2_000
COMMON = 200
SUBSETS = 64
DIGITS = 6
NO_TERM = "-" * DIGITS
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def terms(text: Column) -> Column:
    """The different terms of a text: ASCII letters in lower case, digits, other characters."""
    return F.array_distinct(F.array_remove(F.split(ascii_lower(text), BREAKS), ""))


def term_code(term: Column) -> Column:
    """32 bits of the term's MD5."""
    return F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long")


def lexicon(docs: DataFrame, text: str = "text", rare: int = RARE, common: int = COMMON) -> DataFrame:
    """``(term, code)`` of the terms in the band, counted over all documents.

    In a small corpus a term must be in two documents at least.
    """
    whole = docs.select(whole_text(text).alias("_text"))
    n = whole.count()
    found = whole.select(F.explode(terms(F.col("_text"))).alias("term")).groupBy("term").count()
    band = (F.col("count") * rare >= n) & (F.col("count") * common <= n) & (F.col("count") > 1)
    return written(found.where(band).select("term", term_code(F.col("term")).alias("code")), "lexicon")


def _digests(codes: Column) -> Column:
    """One digest for each part of the lexicon, from the sorted codes of a text."""

    def of(part: Column) -> Column:
        own = F.array_join(F.filter(codes, lambda c: c % SUBSETS == part).cast("array<string>"), ",")
        digest = F.substring(F.md5(F.nullif(own, F.lit(""))), 1, DIGITS)
        return F.coalesce(digest, F.lit(NO_TERM))

    return F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), of)


def _fingerprint(codes: Column, digest: Column) -> Column:
    """``codes`` must be a column, not an expression: each part's digest would work it out anew.

    Digests of the parts; a text without a term of the lexicon has its own digest alone."""
    return F.when(F.size(codes) > 0, _digests(codes)).otherwise(
        F.array(F.concat(F.lit("text "), F.substring(digest, 1, 16)))
    )


def likeness(a: Column, b: Column) -> Column:
    """The share of equal digests among the parts in which either fingerprint has a term.

    Fingerprints without a term of the lexicon are alike only if they are equal.
    """
    def part(text: Column, i: Column) -> Column:
        return F.substring(text, i * DIGITS + 1, F.lit(DIGITS))

    places = F.filter(
        F.sequence(F.lit(0), F.lit(SUBSETS - 1)),
        lambda i: ~((part(a, i) == NO_TERM) & (part(b, i) == NO_TERM)),
    )
    equal = F.size(F.filter(places, lambda i: part(a, i) == part(b, i)))
    whole = SUBSETS * DIGITS
    other = (F.length(a) != whole) | (F.length(b) != whole)
    return F.when(a == b, 1.0).when(other, 0.0).otherwise(equal / F.size(places))


def _place(values: list[int], value: Column, inclusive: bool) -> Column:
    """How many of the sorted ``values`` are below ``value``, or not above it; by bisection."""
    size = 1 << max(1, len(values)).bit_length()
    table = F.array(*[F.lit(v).cast("long") for v in values]) if values else None
    if table is None:
        return F.lit(0)
    steps = F.array(*[F.lit(size >> i) for i in range(1, size.bit_length())])

    def step(at: Column, by: Column) -> Column:
        probe = F.get(table, at + by - 1)
        fits = (probe <= value) if inclusive else (probe < value)
        return F.when((at + by <= len(values)) & fits, at + by).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's key and text with those of the next row by ascending key; the last has the first.

    Columns: ``key``, ``text``, ``h``, ``next_key``, ``next_text``, ``next_h``. Rows with one key
    follow each other by text hash; null keys come first; null texts are empty.

    Keys of whole numbers are their own order; those of any other type that Spark can order, as
    strings or dates, are ranked first, each once, and joined with their rank.

    Keys are cut into pieces at quantiles, a few for each shuffle partition; a key with very
    many rows takes several pieces by text hash. A piece is sorted in one task. The first row
    of each piece, one row a piece, is added to the piece before it, so every text is shuffled
    once.
    """
    spark = docs.sparkSession
    smallest = F.lit(-(1 << 63)).cast("long")
    h, _ = hash_pair(whole_text(text))
    rows = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"), h.alias("h"))
    if isinstance(docs.schema[key].dataType, T.IntegralType):
        rows = rows.withColumn("_o", F.coalesce(F.col("key").cast("long"), smallest))
    else:
        order = ranked(rows.select(F.col("key").alias("_k")).distinct(), [F.col("_k")], "_o", "keys")
        rows = rows.join(order, F.col("key").eqNullSafe(F.col("_k"))).drop("_k")
    # Several for each partition, since a hash deals them out.
    pieces = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    fractions = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
    cuts = rows.agg(F.percentile_approx("_o", fractions, F.lit(4 * pieces)).alias("c")).first()["c"]
    cuts = sorted(cuts or [])
    low, high = _place(cuts, F.col("_o"), False), _place(cuts, F.col("_o"), True)
    # The hash in its signed order, as a fraction.
    part = (F.shiftrightunsigned(F.col("h").bitwiseXOR(smallest), 33) / F.lit(float(1 << 31)))
    piece = low + F.floor(part * (high - low + 1)).cast("int")
    rows = rows.withColumn("piece", piece)

    firsts = rows.groupBy("piece").agg(F.min(F.struct("_o", "h")).alias("first"))
    firsts = written(firsts, "firsts")
    # One row for each piece: bounded by the number of pieces.
    order = W.orderBy("piece")
    before = F.coalesce(F.lag("piece").over(order), F.lit(pieces))
    firsts = firsts.withColumn("before", before).select(
        F.when(F.col("before") == pieces, F.lit(None)).otherwise(F.col("before")).alias("before"),
        F.col("first._o").alias("f_o"), F.col("first.h").alias("f_h"),
    )
    last = rows.agg(F.max("piece")).first()[0] if cuts else 0
    ghosts = (
        rows.join(F.broadcast(firsts), (F.col("_o") == F.col("f_o")) & (F.col("h") == F.col("f_h")))
        .withColumn("piece", F.coalesce("before", F.lit(last)))
        .select("key", "text", "h", "_o", "piece", F.lit(1).alias("ghost"))
    )
    every = rows.select("key", "text", "h", "_o", "piece", F.lit(0).alias("ghost")).unionByName(ghosts)
    inside = W.partitionBy("piece").orderBy("ghost", "_o", "h")
    found = every.select(
        "key", "text", "h", "ghost",
        *[F.lead(c).over(inside).alias(f"next_{c}") for c in ("key", "text", "h")],
    )
    return found.where("ghost = 0").drop("ghost")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its fingerprint, that of its edited text, likenesses.

    The edited text has the last half of the code points, rounded down, replaced by the first
    as many (or all) of the next document's. Columns: the key, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``. A null text is
    empty; equal texts have equal fingerprints; a single document is its own next; further
    columns are ignored.
    """
    words = lexicon(docs, text)
    rows = with_next(docs, key, text)
    half = F.floor(F.char_length("text") / 2).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), F.char_length("text") - half)
    edited = F.concat(kept, F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "key", "h", "next_key", "next_h", "text",
        F.char_length("text").cast("long").alias("n_chars"), edited.alias("edited"),
    )
    # Each side's terms, with an empty one that carries what the row says of itself.
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("own")),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("own")),
    )
    each = rows.select(
        "row", F.struct("key", "h", "next_key", "next_h", "n_chars").alias("about"), F.inline(sides)
    )
    each = each.select(
        "row", "side", "about", F.sha2("own", 256).alias("digest"),
        F.explode(F.concat(F.array(F.lit("")), terms(F.col("own")))).alias("term"),
    )
    marker = words.sparkSession.createDataFrame([("", -1)], "term string, code long")
    coded = each.join(F.broadcast(words.unionByName(marker)), "term").select(
        "row", "side",
        F.when(F.col("code") >= 0, F.col("code")).alias("code"),
        F.when(F.col("code") < 0, F.struct("about", "digest")).alias("said"),
    )
    grouped = coded.groupBy("row").agg(
        F.collect_list(F.when(F.col("side") == 0, F.col("code"))).alias("own"),
        F.collect_list(F.when(F.col("side") == 1, F.col("code"))).alias("other"),
        F.collect_list(F.when(F.col("side") == 0, F.col("said"))).alias("said"),
        F.collect_list(F.when(F.col("side") == 1, F.col("said.digest"))).alias("edited_sha256"),
    )
    said = F.get("said", F.lit(0))
    about = said["about"]
    ordered = grouped.select(
        *[about[c].alias(c) for c in ("key", "h", "next_key", "next_h", "n_chars")],
        said["digest"].alias("digest"),
        F.get("edited_sha256", F.lit(0)).alias("edited_sha256"),
        F.array_sort(F.array_distinct("own")).alias("own"),
        F.array_sort(F.array_distinct("other")).alias("other"),
    )
    out = ordered.select(
        "key", "h", "next_key", "next_h", "n_chars", "edited_sha256",
        # As one text each, which takes less room than a list of short ones.
        F.array_join(_fingerprint(F.col("own"), F.col("digest")), "").alias("own"),
        F.array_join(_fingerprint(F.col("other"), F.col("edited_sha256")), "").alias("other"),
    )
    out = written(out, "fingerprints")
    # A text's fingerprint depends on the text alone, so any row with that key and hash will do.
    following = out.select(F.col("key").alias("k"), F.col("h").alias("f_h"), F.col("own").alias("following"))
    following = following.dropDuplicates(["k", "f_h"])
    joined = out.join(
        following, F.col("next_key").eqNullSafe(F.col("k")) & (F.col("next_h") == F.col("f_h"))
    )
    return joined.select(
        F.col("key").alias(key),
        "n_chars",
        "edited_sha256",
        F.col("own").alias("fingerprint"),
        F.col("other").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


def oracle_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def words(column: str) -> str:
        return (
            f"list_distinct(regexp_extract_all(translate({column}, '{upper}', '{lower}'),"
            " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))"
        )

    def parts(codes: str) -> str:
        own = f"list_sort(list_filter({codes}, lambda c: c % {SUBSETS} = i))"
        return (
            f"list_transform(range({SUBSETS}), lambda i: CASE WHEN len({own}) = 0 THEN '{NO_TERM}' ELSE"
            f" substr(md5(array_to_string({own}, ',')), 1, {DIGITS}) END)"
        )

    def near(a: str, b: str) -> str:
        said = f"list_filter(range(1, len({a}) + 1), lambda i: {a}[i] <> '{NO_TERM}' OR {b}[i] <> '{NO_TERM}')"
        same = f"list_filter({said}, lambda i: {a}[i] = {b}[i])"
        return (
            f"CASE WHEN {a} = {b} THEN 1.0E0 WHEN len({a}) <> len({b}) THEN 0.0E0"
            f" ELSE len({same}) / len({said}) END"
        )

    def print_of(codes: str, digest: str) -> str:
        return (
            f"CASE WHEN len(coalesce({codes}, [])) > 0 THEN {parts(codes)}"
            f" ELSE ['text ' || substr({digest}, 1, 16)] END"
        )

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
x AS (
  SELECT *, coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id,
    coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next_text
  FROM d),
e AS (
  SELECT *, length(text) AS n_chars,
    substring(text, 1, length(text) - length(text) // 2) || substring(next_text, 1, length(text) // 2) AS edited
  FROM x),
df AS (SELECT term, count(*) AS c FROM (SELECT unnest({words('text')}) AS term FROM d) GROUP BY term),
lex AS (
  SELECT term, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) AS code FROM df
  WHERE c * {RARE} >= (SELECT count(*) FROM d) AND c * {COMMON} <= (SELECT count(*) FROM d) AND c > 1),
o AS (
  SELECT doc_id, list(DISTINCT code) AS codes
  FROM (SELECT doc_id, unnest({words('text')}) AS term FROM d) JOIN lex USING (term) GROUP BY doc_id),
p AS (
  SELECT doc_id, list(DISTINCT code) AS codes
  FROM (SELECT doc_id, unnest({words('edited')}) AS term FROM e) JOIN lex USING (term) GROUP BY doc_id),
f AS (
  SELECT e.doc_id, next_id, n_chars, sha256(edited) AS edited_sha256,
    {print_of('o.codes', 'sha256(text)')} AS own, {print_of('p.codes', 'sha256(edited)')} AS other
  FROM e LEFT JOIN o USING (doc_id) LEFT JOIN p ON p.doc_id = e.doc_id)
SELECT f.doc_id, f.n_chars, f.edited_sha256, array_to_string(f.own, '') AS fingerprint,
  array_to_string(f.other, '') AS edited_fingerprint,
  {near('f.own', 'f.other')} AS near_edited, {near('f.own', 'g.own')} AS near_next
FROM f JOIN f AS g ON f.next_id = g.doc_id"""
