"""Line deduplication by log templates, in DataFrame functions only.

A line is cut at white space; a token with a digit becomes ``<*>``. The tree has a fixed
depth: the number of tokens, then the first ``DEPTH`` tokens. In a leaf the places behind these
are cut into ``RANGES`` ranges of equal length, and a line has one template for each pair of
them: itself with both ranges generalised. So lines of a leaf share a template if what differs
lies in two ranges, which in a line of up to ``DEPTH + RANGES`` tokens are any two tokens. A
template counts if seven tenths of its tokens are constant. Where no pair that has a range
counts, the template with that range alone may. Lines of fewer than ``LEAST_TOKENS`` tokens have
no template but themselves, masked.

What is found in two documents or more, a masked line or a template, is dropped from all of
them but one: it stays in the document that comes first, so text that many documents share is
not lost altogether. Counts cover all documents and nothing depends on the order of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.llm.common import hash_pair
from epitally.workspace import written

DEPTH = 3
RANGES = 8
LEAST_TOKENS = 6
WILD = "<*>"
# Share of a template's tokens, in tenths.
CONSTANT_TENTHS = 7

SPACE = "[\\x20\\x09-\\x0D]"
OTHER = "[^\\x20\\x09-\\x0D]"
_TRIMMED = " \t\x0b\x0c\r"


def masked(each: DataFrame, line: str) -> DataFrame:
    """``each`` with the line's tokens joined by one space and those with a digit generalised.

    Lines without a token go. That is tested on the first step: a test of the finished line
    would be pushed below it and work all steps out again. A column for each step, so that
    none is worked out twice.
    """
    uneven = F.col("_trimmed").contains("  ")
    for c in _TRIMMED[1:]:
        uneven = uneven | F.col("_trimmed").contains(c)
    spaced = F.when(uneven, F.regexp_replace("_trimmed", f"{SPACE}+", " "))
    digits = F.when(
        F.col("_even").rlike("[0-9]"), F.regexp_replace("_even", f"{OTHER}*[0-9]{OTHER}*", WILD)
    )
    return (
        each.withColumn("_trimmed", F.btrim(line, F.lit(_TRIMMED)))
        .where("_trimmed != ''")
        .withColumn("_even", spaced.otherwise(F.col("_trimmed")))
        .withColumn("_line", digits.otherwise(F.col("_even")))
        .drop("_trimmed", "_even", line)
    )


def _edge(n: Column, i: int) -> Column:
    return F.floor((n - DEPTH) * i / RANGES).cast("int") + DEPTH


def _parts(tokens: Column) -> list[Column]:
    """The hash of each range of the line."""
    n = F.size(tokens)
    edges = [_edge(n, i) for i in range(RANGES + 1)]
    return [F.xxhash64(F.slice(tokens, a + 1, b - a)) for a, b in zip(edges, edges[1:])]


def _templates(n: Column, wild: Column, parts: list[Column]) -> Column:
    """The line's templates ``(i, f)``, without what the leaf says: which ranges are generalised,
    and the hash of the others."""
    size = [_edge(n, i + 1) - _edge(n, i) for i in range(RANGES)]

    def counts(length: Column) -> Column:
        return (n - length - wild) * 10 >= n * CONSTANT_TENTHS

    def template(*gone: int) -> Column:
        rest = [p for j, p in enumerate(parts) if j not in gone]
        i = F.lit(sum(1 << g for g in gone))
        return F.struct(i.alias("i"), F.xxhash64(i, *rest).alias("f"))

    # The last range is never shorter than another one; the shortest that is not empty has as
    # many tokens as fit into all, and at least one.
    least = F.greatest(F.floor((n - DEPTH) / RANGES).cast("int"), F.lit(1))
    out = []
    for i in range(RANGES):
        alone = (size[i] > 0) & counts(size[i]) & ~counts(size[i] + least)
        out.append(F.when(alone, template(i)))
        for j in range(i):
            both = (size[i] > 0) & (size[j] > 0) & counts(size[i] + size[j])
            out.append(F.when(both, template(j, i)))
    return F.array_compact(F.array(*out))


def _lines(named: DataFrame, templates: bool) -> DataFrame:
    """Each line with a token: document, place, hash, and its place in the tree: leaf hash, number
    of tokens, of generalised ones, and the ranges' hashes."""
    each = named.select("_d1", "_d2", "_key", F.posexplode(F.split("_text", "\n")).alias("pos", "_raw"))
    each = masked(each, "_raw")
    m1, m2 = hash_pair(F.col("_line"))
    if not templates:
        return each.select("_d1", "_d2", "_key", "pos", m1.alias("m1"), m2.alias("m2"))
    each = each.select("_key", "_line", m1.alias("m1"), m2.alias("m2"), F.split("_line", " ").alias("_tokens"))
    tokens = F.col("_tokens")
    tall = F.size(tokens) >= LEAST_TOKENS
    leaf = F.xxhash64(F.size(tokens), F.slice(tokens, 1, DEPTH))
    wild = F.size(F.filter(tokens, lambda t: t == WILD))
    return each.select(
        "_key", "m1", "m2", F.when(tall, leaf).alias("leaf"), F.size(tokens).alias("size"),
        F.when(tall & F.col("_line").contains(WILD), wild).otherwise(0).alias("wild"),
        *[F.when(tall, p).alias(f"p{i}") for i, p in enumerate(_parts(tokens))],
    )


def recurring(named: DataFrame) -> DataFrame:
    """``(m1, m2, stays)``: masked lines to drop, and the key of the document they stay in.

    Lines are counted by a hash aggregate, so a line that very many documents have is one row
    for each task before it is shuffled. Templates are made only for the leaves with several
    different lines, from those lines, each once.
    """
    tree = ["leaf", "size", "wild", *[f"p{i}" for i in range(RANGES)]]
    lines = written(
        _lines(named, True)
        .groupBy("m1", "m2", *tree)
        .agg(
            F.count("*").alias("n"),
            F.count("_key").alias("keyed"),
            F.min("_key").alias("first"),
            F.max("_key").alias("last"),
        ),
        "lines",
    )
    several = "(first != last OR (keyed > 0 AND keyed < n))"
    leaves = lines.where("leaf IS NOT NULL").groupBy("leaf").count().where("count > 1")
    # The small side of each join below is a table of its own, so that the join has an exchange
    # on either side and Spark can split what is hot: a leaf with very many different lines, a
    # template of very many, a line that very many documents have.
    leaves = written(leaves.select("leaf"), "leaves")
    forms = _templates(F.col("size"), F.col("wild"), [F.col(f"p{i}") for i in range(RANGES)])
    each = lines.join(leaves, "leaf").select(
        "m1", "m2", "leaf", "n", "keyed", "first", "last", F.inline(forms)
    )
    each = written(each, "templates")
    shared = written(
        each
        .groupBy("leaf", "i", "f")
        .agg(
            F.count("*").alias("lines"),
            F.sum("n").alias("n"),
            F.sum("keyed").alias("keyed"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
        .where(f"lines > 1 AND {several}")
        .withColumnRenamed("first", "t_first")
        .select("leaf", "i", "f", "t_first"),
        "shared",
    )
    general = each.join(shared, ["leaf", "i", "f"]).groupBy("m1", "m2").agg(
        F.min("t_first").alias("t_first"), F.lit(True).alias("general")
    )
    both = lines.drop(*tree).join(general, ["m1", "m2"], "left")
    return written(
        both.where(f"{several} OR general").select(
            "m1", "m2", F.coalesce(F.least("t_first", "first"), "t_first", "first").alias("stays")
        ),
        "stays",
    )


def drop_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without recurring lines, with ``n_lines`` and ``n_dropped``; all rows stay.

    Lines end at ``\\n``. Lines without a token never count and always stay. A null text
    stays null with no lines, an empty one has one empty line. Documents are told apart by
    key: rows with equal keys all keep what stays in that document, and null keys are one
    document, the last. What only one document holds does not recur, however often it holds
    it. Columns already named like the two added ones are replaced; others are kept.
    """
    docs = docs.drop("n_lines", "n_dropped")
    d1, d2 = hash_pair(F.col(key), F.col(text))
    others = [c for c in docs.columns if c != text]
    same = [d1.alias("_d1"), d2.alias("_d2")]
    named = docs.select(*same, F.col(key).alias("_key"), F.col(text).alias("_text"))
    rows = docs.select(*same, F.split(text, "\n").alias("_lines"), F.struct(*others).alias("_row"))
    stays = recurring(named)
    gone = (
        _lines(named, False)
        .join(stays, ["m1", "m2"])
        .where(~F.col("_key").eqNullSafe(F.col("stays")))
        .groupBy(F.col("_d1").alias("g1"), F.col("_d2").alias("g2"))
        .agg(F.collect_set("pos").alias("_gone"))
    )
    joined = rows.join(gone, [rows["_d1"] == gone["g1"], rows["_d2"] == gone["g2"]], "left")
    n = F.size("_lines")
    places = F.array_except(F.sequence(F.lit(0), n - 1), F.col("_gone"))
    left = F.transform(places, lambda i: F.get("_lines", i))
    kept = F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(left)
    whole = F.col("_lines").isNotNull()
    return joined.select(
        *[
            (F.array_join(kept, "\n") if c == text else F.col("_row")[c]).alias(c)
            for c in docs.columns
        ],
        F.when(whole, n).otherwise(0).cast("long").alias("n_lines"),
        F.when(F.col("_gone").isNotNull(), F.size("_gone")).otherwise(0).cast("long").alias("n_dropped"),
    )


def oracle_sql() -> str:
    space, other = "[\\x20\\x09-\\x0D]", "[^\\x20\\x09-\\x0D]"
    blank = " || ".join(["' '", "chr(9)", "chr(11)", "chr(12)", "chr(13)"])

    def mask(line: str) -> str:
        plain = f"regexp_replace(trim({line}, {blank}), '{space}+', ' ', 'g')"
        return f"regexp_replace({plain}, '{other}*[0-9]{other}*', '{WILD}', 'g')"

    def edge(i: int) -> str:
        return f"({DEPTH} + (n - {DEPTH}) * {i} // {RANGES})"

    def size(i: int) -> str:
        return f"({edge(i + 1)} - {edge(i)})"

    def counts(length: str) -> str:
        wild = f"len(list_filter(tokens, lambda t: t = '{WILD}'))"
        return f"(n - ({length}) - {wild}) * 10 >= n * {CONSTANT_TENTHS}"

    def form(*gone: int) -> str:
        left = [f"tokens[{edge(k) if k else 0} + 1:{edge(k + 1)}]" for k in range(RANGES) if k not in gone]
        if 0 in gone:
            left.insert(0, f"tokens[1:{DEPTH}]")
        some = " AND ".join(f"{size(k)} > 0" for k in gone)
        if len(gone) == 1:
            least = f"greatest((n - {DEPTH}) // {RANGES}, 1)"
            some += f" AND {counts(size(gone[0]))} AND NOT {counts(f'{size(gone[0])} + {least}')}"
        else:
            some += f" AND {counts(' + '.join(map(size, gone)))}"
        name = "-".join(map(str, gone))
        return f"""
  SELECT line, docs, first, n, [{", ".join(left)}] AS rest, '{name}' AS i
  FROM l WHERE n >= {LEAST_TOKENS} AND {some}"""

    pairs = [(j, i) for i in range(RANGES) for j in range(i)]
    forms = "\n  UNION ALL".join(form(*gone) for gone in [*((i,) for i in range(RANGES)), *pairs])
    return f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
e AS (
  SELECT doc_id, unnest(list_distinct(list_transform(lines, lambda l: {mask('l')}))) AS line FROM d),
m AS (
  SELECT line, string_split(line, ' ') AS tokens, count(*) AS docs, min(doc_id) AS first
  FROM e WHERE line <> '' GROUP BY line),
l AS (SELECT *, len(tokens) AS n FROM m),
t AS ({forms}),
g AS (
  SELECT n, rest, i, min(first) AS t_first FROM t GROUP BY n, rest, i
  HAVING count(*) > 1 AND (max(docs) > 1 OR min(first) <> max(first))),
h AS (SELECT line, min(t_first) AS t_first FROM t JOIN g USING (n, rest, i) GROUP BY line),
r AS (
  SELECT line, least(coalesce(t_first, first), first) AS stays
  FROM l LEFT JOIN h USING (line) WHERE docs > 1 OR t_first IS NOT NULL),
x AS (SELECT doc_id, list(e.line) AS gone FROM e JOIN r USING (line) WHERE doc_id <> stays GROUP BY doc_id),
k AS (
  SELECT doc_id, len(lines) AS n, list_filter(lines, lambda l:
    NOT list_contains(coalesce(gone, []), {mask('l')})) AS kept
  FROM d LEFT JOIN x USING (doc_id))
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_lines,
  CAST(coalesce(n - len(kept), 0) AS BIGINT) AS n_dropped,
  sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256
FROM k"""
