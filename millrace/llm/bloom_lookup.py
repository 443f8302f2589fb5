"""Document fingerprints: invertible Bloom lookup sketches (DataFrame functions only).

A text is the set of its paragraphs' 64-bit digests. A sketch spreads each digest
over three cells, one in each third; a cell holds a count, the xor of its digests
and the xor of their checks. Sketches of two versions subtract cell by cell, what
they share cancels, and peeling cells that hold one digest recovers the digests
that differ. Where the fixed-size fingerprints cannot be peeled, each version makes a
larger sketch of its own: as many blocks (a digest's leading bits choose one) as the
unpeeled cells let expect differences. Blocks subtract and peel one by one; a block that fails
is made anew by both versions with twice the cells, and so on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import read, shuffle_parts

#: A paragraph: a line, cut at the first sentence end after 120 characters or at 400.
PARAGRAPH = r"[^\n]{120,400}?[.!?]+|[^\n]{1,400}"
#: log2 of the cells in a third of the fingerprint, and the first digest bit they use.
BASE = (3, 0)
#: The same for the tries of a block: 6, 12, 24, 48 and 96 cells.
RETRIES = ((1, 9), (2, 12), (3, 18), (4, 27), (5, 39))
#: Differing digests that a block of the larger sketches is expected to hold, at most.
BLOCK_DIGESTS = 2
ROUNDS = 8


def digests(text: Column) -> Column:
    """Distinct paragraph digests of a text; null and empty texts have none."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(p)))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _check(d: Column) -> Column:
    return F.xxhash64(d, F.lit(17))


def _placed(d: Column, sign: Column, check: Column, size: tuple[int, int]) -> Column:
    """A digest with its sign, its check and its cell in each third."""
    bits, offset = size
    width = (1 << bits) - 1
    cells = [(F.shiftright(d, offset + bits * t).bitwiseAND(F.lit(width).cast("long")).cast("int")
              + F.lit(t << bits)).alias(f"p{t}") for t in range(3)]
    return F.struct(d.alias("d"), sign.alias("s"), check.alias("c"), *cells)


def _cells_with(begin: Column, entries: Column, factor: int) -> Column:
    """Cells ``begin`` after adding (factor 1) or removing (-1) the entries."""
    return F.transform(begin, lambda cell, i: F.aggregate(
        F.filter(entries, lambda x: (x["p0"] == i) | (x["p1"] == i) | (x["p2"] == i)), cell,
        lambda acc, x: F.struct((acc["n"] + x["s"] * factor).alias("n"), acc["k"].bitwiseXOR(x["d"]).alias("k"),
                                acc["c"].bitwiseXOR(x["c"]).alias("c"))))


def _sketch(ds: Column, size: tuple[int, int]) -> Column:
    """Cells of one version's digests."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("c"))
    return _let(F.transform(ds, lambda d: _placed(d, F.lit(1), _check(d), size)),
                lambda entries: _cells_with(F.array_repeat(zero, 3 << size[0]), entries, 1))


def _subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"),
                                                  x["c"].bitwiseXOR(y["c"]).alias("c")))


def _none() -> Column:
    return F.array().cast("array<bigint>")


def _peel(cells: Column, size: tuple[int, int]) -> Column:
    """struct(ok, only_a, only_b): the differing digests that were recovered, and whether nothing is left."""
    def pure(state: Column) -> Column:
        return F.array_distinct(F.transform(
            F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (_check(c["k"]) == c["c"])),
            lambda c: _placed(c["k"], c["n"], c["c"], size)))

    def of(found: Column, sign: int) -> Column:
        return F.transform(F.filter(found, lambda x: x["s"] == sign), lambda x: x["d"])

    def without(state: Column, found: Column) -> Column:
        return F.when(F.size(found) == 0, F.struct(
            state["cells"].alias("cells"), state["a"].alias("a"), state["b"].alias("b"), F.lit(False).alias("go"))
        ).otherwise(F.struct(
            _cells_with(state["cells"], found, -1).alias("cells"), F.concat(state["a"], of(found, 1)).alias("a"),
            F.concat(state["b"], of(found, -1)).alias("b"), F.lit(True).alias("go")))

    def step(state: Column, _: Column) -> Column:
        return F.when(state["go"], _let(pure(state), lambda found: without(state, found))).otherwise(state)

    begin = F.struct(cells.alias("cells"), _none().alias("a"), _none().alias("b"), F.lit(True).alias("go"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, step, lambda s: F.struct(
        (~F.exists(s["cells"], lambda c: (c["n"] != 0) | (c["k"] != 0) | (c["c"] != 0))).alias("ok"),
        s["a"].alias("only_a"), s["b"].alias("only_b")))


def _expected_difference(cells: Column, n_a: Column, n_b: Column) -> Column:
    """How many digests differ, as the subtracted cells let expect.

    A third of m cells has sum(n^2) = D * (1 - 1/m) + (n_a - n_b)^2 / m on average. The
    estimate only sets the size of the next sketch.
    """
    m = 1 << BASE[0]
    squares = F.aggregate(cells, F.lit(0).cast("long"), lambda s, c: s + c["n"].cast("long") * c["n"]) / 3
    more = F.abs(n_a - n_b).cast("long")
    return F.least(F.greatest((squares - more * more / m) / (1 - 1 / m), more.cast("double"), F.lit(1.0)),
                   (n_a + n_b).cast("double"))


def _blocks(ds: Column, bits: Column, side: int) -> Column:
    """A version's digests by block (their leading bits): array of (block, side, digests), none of them empty."""
    def cut(xs: Column) -> Column:
        lead = F.transform(xs, lambda x: F.call_function("shiftright", F.shiftright(x, 33), F.lit(31) - bits))
        return _let(lead, lambda names: _let(
            F.filter(F.sequence(F.lit(1), F.size(xs)), lambda i: (i == F.size(xs)) | (names[i - 1] != F.get(names, i))),
            lambda ends: F.transform(ends, lambda e, j: _let(
                F.when(j == 0, F.lit(0)).otherwise(ends[F.greatest(j - 1, F.lit(0))]),
                lambda begin: F.struct(names[e - 1].alias("block"), F.lit(side).alias("side"),
                                       F.slice(xs, begin + 1, e - begin).alias("ds"))))))

    return F.when(F.size(ds) == 0, F.array().cast("array<struct<block:bigint,side:int,ds:array<bigint>>>")).otherwise(
        _let(F.sort_array(ds), cut))


def _facing(blocks: Column) -> Column:
    """Blocks of both versions by name: array of (a, b), an empty array where a version has no digest in a block."""
    def face(xs: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(xs) - 1),
                          lambda i: (i == 0) | (xs[F.greatest(i - 1, F.lit(0))]["block"] != xs[i]["block"]))
        return F.transform(begins, lambda i: _let(
            F.struct(xs[i].alias("x"), F.get(xs, i + 1).alias("y")), lambda p: F.struct(
                F.when(p["x"]["side"] == 0, p["x"]["ds"]).otherwise(_none()).alias("a"),
                F.when(p["x"]["side"] == 1, p["x"]["ds"])
                .when(p["y"]["block"] == p["x"]["block"], p["y"]["ds"]).otherwise(_none()).alias("b"))))

    return F.when(F.size(blocks) == 0, F.array().cast("array<struct<a:array<bigint>,b:array<bigint>>>")).otherwise(
        _let(F.sort_array(blocks), face))


def _solve(block: Column) -> Column:
    """Differing digests of one block: both versions sketch it, with more cells after each failure.

    ``tries`` tells how many sketches it took. A block that the largest sketch cannot peel (digests that share
    all cells of every size) is settled by its digests themselves and counts one try more.
    """
    def attempt(k: int) -> Column:
        if k == len(RETRIES):
            return F.struct(F.lit(k + 1).alias("tries"), F.array_except(block["a"], block["b"]).alias("only_a"),
                            F.array_except(block["b"], block["a"]).alias("only_b"))
        size = RETRIES[k]
        return _let(_peel(_subtract(_sketch(block["a"], size), _sketch(block["b"], size)), size),
                    lambda r: F.when(r["ok"], F.struct(F.lit(k + 1).alias("tries"), r["only_a"].alias("only_a"),
                                                       r["only_b"].alias("only_b"))).otherwise(attempt(k + 1)))

    return attempt(0)


def fingerprint_cells(ds: Column) -> Column:
    return _sketch(ds, BASE)


def fingerprint_text(ds: Column, cells: Column) -> Column:
    """The fingerprint as text: number of digests, then each cell's count, xor and check in hexadecimal."""
    return F.concat(F.hex(F.size(ds)), F.lit(":"), F.array_join(F.transform(cells, lambda c: F.concat(
        F.hex(c["n"]), F.lit("."), F.hex(c["k"]), F.lit("."), F.hex(c["c"].bitwiseAND(F.lit(0xFFFFFFFF))))), "-"))


def with_difference(df: DataFrame, a: str, b: str, a_cells: str, b_cells: str, out: str) -> DataFrame:
    """Add ``out``: struct(tries, only_a, only_b), the digests that only one of two versions has.

    ``a`` and ``b`` are digest columns without repeats, the cells their fingerprints, which are subtracted
    and peeled first (``tries`` 0). Otherwise ``tries`` is the most sketches that a block took.
    The order inside the two arrays is of no meaning.
    """
    # steps of their own: each is evaluated once and stays small
    df = df.withColumn("__cells", _subtract(F.col(a_cells), F.col(b_cells)))
    df = df.withColumn("__base", _peel(F.col("__cells"), BASE))
    expected = _expected_difference(F.col("__cells"), F.size(a), F.size(b))
    bits = F.least(F.ceil(F.log2(F.greatest(expected / BLOCK_DIGESTS, F.lit(1.0)))), F.lit(30)).cast("int")
    df = df.withColumn("__bits", F.when(~F.col("__base.ok"), bits))
    df = df.withColumn("__blocks", F.when(~F.col("__base.ok"), F.concat(
        _blocks(F.col(a), F.col("__bits"), 0), _blocks(F.col(b), F.col("__bits"), 1))))
    df = df.withColumn("__facing", F.when(~F.col("__base.ok"), _facing(F.col("__blocks"))))
    df = df.withColumn("__solved", F.transform("__facing", _solve))
    found = F.when(F.col("__base.ok"), F.struct(F.lit(0).alias("tries"), F.col("__base.only_a").alias("only_a"),
                                                F.col("__base.only_b").alias("only_b"))).otherwise(
        F.struct(F.array_max(F.transform("__solved", lambda r: r["tries"])).alias("tries"),
                 F.flatten(F.transform("__solved", lambda r: r["only_a"])).alias("only_a"),
                 F.flatten(F.transform("__solved", lambda r: r["only_b"])).alias("only_b")))
    return df.withColumn(out, found).drop("__cells", "__base", "__bits", "__blocks", "__facing", "__solved")


def with_likeness(df: DataFrame, a: str, b: str, a_cells: str, b_cells: str, out: str) -> DataFrame:
    """Add the share of two texts' paragraphs that did not differ (1 for equal sets, also for two empty ones)."""
    df = with_difference(df, a, b, a_cells, b_cells, "__found")
    total = F.size(a) + F.size(b)
    return df.withColumn(out, F.when(total == 0, F.lit(1.0)).otherwise(
        F.lit(1.0) - (F.size("__found.only_a") + F.size("__found.only_b")).cast("double") / total)).drop("__found")


def _ranges(ids: DataFrame, column: str, parts: int) -> Column:
    """Range number of an id that is not null, below ``parts``: quantile bounds, found by a two-level search."""
    bounds = sorted(set(ids.approxQuantile(column, [i / parts for i in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    fine = F.array(*[F.lit(float(b)) for b in bounds])
    coarse = F.array(*[F.lit(float(b)) for b in bounds[step - 1::step]])
    value = F.col(column).cast("double")
    before = F.size(F.filter(coarse, lambda b: b <= value)) * step
    found = before + F.size(F.filter(F.slice(fine, before + 1, F.lit(step)), lambda b: b <= value))
    return found


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """``id``, ``text`` and the text of the next row by id (``next_text``); after the last comes the first.

    Rows are dealt out by ranges of the id (numeric; null ids come last, by ranges of a hash
    of their text), so order holds without one task for all. Each range gets a copy of the row that follows
    it: at most one row per range travels twice. Rows that repeat an id are ordered
    by a hash of their text. Null texts are empty.
    """
    parts = parts or shuffle_parts(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    number = _ranges(rows.filter(F.col("id").isNotNull()).select("id"), "id", parts)
    # rows without an id are in order of the tie alone, a uniform hash: its leading bits are their ranges
    later = F.lit(parts) + F.floor((F.shiftright("__tie", 48) + 32768) * parts / 65536).cast("int")
    dealt = rows.withColumn("__tie", F.xxhash64("text")).withColumn(
        "__range", F.when(F.col("id").isNull(), later).otherwise(number))
    order = [F.col("id").asc_nulls_last(), F.col("__tie")]
    # the first row of each range, one narrow row per range
    heads = (dealt.groupBy("__range").agg(F.min(F.struct(F.col("id").isNull().alias("z"), "id", "__tie")).alias("h"))
             .orderBy("__range").collect())
    if not heads:
        return rows.withColumn("next_text", F.col("text"))
    names = [h["__range"] for h in heads]
    follow = docs.sparkSession.createDataFrame(
        [(h["h"]["id"], h["h"]["__tie"], names[i - 1]) for i, h in enumerate(heads)],
        f"__id {docs.schema[id_col].dataType.simpleString()}, __head bigint, __of int")
    copies = (dealt.join(F.broadcast(follow), F.col("id").eqNullSafe(F.col("__id")) & (F.col("__tie") == F.col("__head")))
              .select("id", "text", F.col("__of").alias("__range"), "__tie", F.lit(1).alias("__copy")))
    both = dealt.withColumn("__copy", F.lit(0)).unionByName(copies)
    w = Window.partitionBy("__range").orderBy("__copy", *order)
    return (both.withColumn("next_text", F.lead("text").over(w)).filter("__copy = 0")
            .select("id", "text", "next_text"))


def op6_bloom_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and what the sketches say about them.

    Null texts count as empty; rows that repeat a document are followed by their
    copy; an empty table gives no rows.
    """
    rows = with_next(read(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.length("text")
    edited = F.concat(F.expr("left(text, length(text) - int(floor(length(text) / 4)))"),
                      F.expr("left(next_text, int(floor(length(text) / 4)))"))
    rows = rows.select(F.col("id").alias("doc_id"), n.cast("long").alias("n_chars"), "text", edited.alias("edited"),
                       "next_text")
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("a"),
                       digests(F.col("edited")).alias("e"), digests(F.col("next_text")).alias("x"))
    for d in "aex":
        rows = rows.withColumn(f"{d}c", fingerprint_cells(F.col(d)))
    rows = with_likeness(rows, "a", "e", "ac", "ec", "near_edited")
    rows = with_likeness(rows, "a", "x", "ac", "xc", "near_next")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint_text(F.col("a"), F.col("ac")).alias("fingerprint"),
        fingerprint_text(F.col("e"), F.col("ec")).alias("edited_fingerprint"), "near_edited", "near_next")
