"""Document fingerprints: SimHash of weighted word pairs and search by permuted block tables, DataFrame functions only.

Every pair of neighbouring words of a text, its first and last word paired with nothing, votes with its weight
on the 128 bits of its hash; a bit of the fingerprint is 1 if it has over half of the weight. To find all
fingerprints within a radius of r bits, the bits are split into blocks, of which r differing bits leave at least
``blocks - r`` untouched. For each choice of so many blocks there is a table that has these blocks in front: a
query reads what has the same front as itself and verifies the whole distance.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import documents, stage

BITS = 128
RADIUS = 3
BLOCKS = 4
LIST = 1024  # fingerprints of a block table that are compared as one row

ROWS = 4096  # wanted rows of a piece of the document order
PIECES = 16_384  # most pieces; beyond it they have more rows each
_STRIDE = 128
_PLACE = 40  # bits for the place of a row in its piece
_FINE = 1 << 30

_LANES = 0x0000000100000001  # bits k and k + 32 of a hash are counted in the two halves of one long
_HALF = 0xFFFFFFFF


def terms(text: Column) -> Column:
    """Pairs ``(a, b)`` of neighbouring words in lower case, the outer ones paired with an empty word; none without words."""
    words = F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")
    ends = F.array(F.lit(""))
    return F.when(F.size(words) > 0, F.arrays_zip(F.concat(ends, words), F.concat(words, ends)))


def _weight() -> Column:
    """1 to 3: one more for each word of over three characters; short words are mostly common ones."""
    return (F.lit(1) + (F.length("a") > 3).cast("int") + (F.length("b") > 3).cast("int")).cast("long")


def _either(parts: Sequence[Column]) -> Column:
    if len(parts) == 1:
        return parts[0]
    middle = len(parts) // 2
    return _either(parts[:middle]).bitwiseOR(_either(parts[middle:]))


def simhash(rows: DataFrame, keys: Sequence[str], text_col: str = "text") -> DataFrame:
    """``keys, hi, lo``: the fingerprint of every row; ``keys`` tell the rows apart. Zero for a text without words.

    Texts are told apart by their words only. The votes of a row are summed in the task that has it, so what is
    shuffled is one row of counts for each. A text that fits in a row has too few words for a half to overflow.
    """
    voting = rows.select(*keys, F.inline_outer(terms(F.col(text_col))).alias("a", "b")).select(
        *keys, F.coalesce(_weight(), F.lit(0)).alias("w"), F.xxhash64("a", "b").alias("h0"), F.xxhash64("b", F.lit(1), "a").alias("h1")
    )
    votes = [
        F.sum(F.col("w") * F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_LANES))).alias(f"{h}_{k}") for h in ("h0", "h1") for k in range(32)
    ]
    counted = voting.groupBy(*keys).agg(F.sum("w").alias("w"), *votes)

    def bits(h: str) -> Column:
        made = []
        for k in range(32):
            low, high = F.col(f"{h}_{k}").bitwiseAND(F.lit(_HALF)), F.shiftrightunsigned(f"{h}_{k}", 32)
            for count, place in ((low, k), (high, k + 32)):
                made.append(F.shiftleft((2 * count > F.col("w")).cast("long"), place))
        return _either(made)

    return counted.select(*keys, bits("h0").alias("hi"), bits("h1").alias("lo"))


def as_text(hi: str = "hi", lo: str = "lo") -> Column:
    """32 lowercase hex digits."""
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def differing(a_hi: Column, a_lo: Column, b_hi: Column, b_lo: Column) -> Column:
    """Number of bits that two fingerprints differ in."""
    return F.bit_count(a_hi.bitwiseXOR(b_hi)) + F.bit_count(a_lo.bitwiseXOR(b_lo))


def likeness(a_hi: Column, a_lo: Column, b_hi: Column, b_lo: Column) -> Column:
    """Share of equal bits: about 0.5 for unrelated texts, 1 for equal ones."""
    return 1 - differing(a_hi, a_lo, b_hi, b_lo) / F.lit(float(BITS))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _fronts(blocks: int, radius: int) -> list[tuple[int, int]]:
    """For each table the masks (of hi, of lo) of the blocks in front."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError(f"blocks must be more than the radius and at most {BITS}, got {blocks} and {radius}")
    edges = [round(BITS * i / blocks) for i in range(blocks + 1)]
    masks = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    fronts = [reduce(int.__or__, chosen) for chosen in combinations(masks, blocks - radius)]
    return [(_signed(front >> 64), _signed(front & ((1 << 64) - 1))) for front in fronts]


def block_tables(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """The rows of ``prints(hi, lo, ...)`` once for each table, with its number and the bits in front: ``table, f_hi, f_lo``."""
    fronts = [
        F.struct(
            F.lit(t).alias("table"),
            F.col("hi").bitwiseAND(F.lit(hi)).alias("f_hi"),
            F.col("lo").bitwiseAND(F.lit(lo)).alias("f_lo"),
        )
        for t, (hi, lo) in enumerate(_fronts(blocks, radius))
    ]
    return prints.select(F.inline(F.array(*fronts)), "*")


def search(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, longest: int = LIST) -> DataFrame:
    """All of ``prints(hi, lo, n)``, each fingerprint once, within ``radius`` bits of each of ``queries(hi, lo)``.

    Rows ``hi, lo, found``: an array of ``(hi, lo, n)``, never empty. A query may have several rows; over all of them
    it meets each fingerprint once. Equal fronts are held as lists of about ``longest`` fingerprints,
    so that many fingerprints with one front spread over tasks, and a query makes a row for each list, not for
    each fingerprint. ``prints`` is a written table: it is read several times.
    """
    fronts = _fronts(blocks, radius)
    front = ["table", "f_hi", "f_lo"]
    table = block_tables(prints.select("hi", "lo", "n"), radius, blocks)
    crowded = stage(table.groupBy(*front).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > longest), "crowded")
    dealt = table.join(crowded, front, "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("hi", "lo"), F.ceil(F.col("rows") / longest)), F.lit(0))
    )
    lists = dealt.groupBy(*front, "part").agg(F.collect_list(F.struct("hi", "lo", "n")).alias("list"))
    probes = block_tables(queries.select("hi", "lo").distinct(), radius, blocks)
    met = probes.join(lists, front)

    def seen_before(x: Column) -> Column:
        # An earlier table has the pair if its front is equal, too.
        earlier = [
            (F.col("table") > t)
            & (x["hi"].bitwiseXOR(F.col("hi")).bitwiseAND(F.lit(hi)) == 0)
            & (x["lo"].bitwiseXOR(F.col("lo")).bitwiseAND(F.lit(lo)) == 0)
            for t, (hi, lo) in enumerate(fronts[:-1])
        ]
        return reduce(Column.__or__, earlier, F.lit(False))

    near = F.filter("list", lambda x: (differing(x["hi"], x["lo"], F.col("hi"), F.col("lo")) <= radius) & ~seen_before(x))
    return met.select("hi", "lo", near.alias("found")).filter(F.size("found") > 0)


def _pieces(docs: DataFrame) -> tuple[DataFrame, Column]:
    """The keys of ``docs(doc_id, text)``, written, and the piece of the order that a row with ``doc_id, fine`` is in.

    Pieces are about equal; their numbers never fall with the id, nor with ``fine``, a hash of the text, among equal ids.
    """
    keys = stage(docs.select("doc_id", _fine().alias("fine")), "keys")
    n, least = keys.agg(F.count(F.lit(1)), F.min("doc_id")).first()
    # Without an id: below all ids, or as low as the least where a double has no smaller step.
    whole = F.coalesce(F.col("doc_id").cast("double"), F.lit(float(least or 0) - 1.0))
    at = whole + F.col("fine") / float(_FINE)
    pieces = min(PIECES, ceil(n / ROWS))
    if pieces < 2:
        return keys, F.lit(0)
    found = keys.agg(F.percentile_approx(at, [i / pieces for i in range(1, pieces)], max(10_000, 4 * pieces))).first()[0]
    points = sorted(set(found))
    # Compares with every 128th split point first and then only with those between two of them.
    coarse = F.lit(points[_STRIDE - 1 :: _STRIDE]) if len(points) >= _STRIDE else F.array().cast("array<double>")
    start = F.size(F.filter(coarse, lambda p: p < at)) * _STRIDE
    return keys, start + F.size(F.filter(F.slice(F.lit(points), start + 1, F.lit(_STRIDE)), lambda p: p < at))


def _fine() -> Column:
    return F.pmod(F.xxhash64("text"), F.lit(_FINE))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document beside the one that follows it: ``row, doc_id, text, next_row, next_text``.

    The order is that of descending ids; the last document is followed by the first. Rows with equal ids follow
    one another in an order that depends on their texts only, rows without an id come after all others; equal
    rows are interchangeable. Nulls count as empty texts. ``row`` numbers the rows.

    The order is cut into pieces at approximate quantiles; a copy of the first row of the next piece ends each
    one, so that whole texts are shuffled once, by piece. Rows that are equal in id and text share a piece.
    """
    docs = documents(docs, id_col, text_col)
    keys, piece = _pieces(docs)
    rank = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "fine")
    tops = keys.withColumn("piece", piece).groupBy("piece").agg(F.max(rank).alias("first")).collect()  # a row for each piece
    firsts = sorted((r["piece"], r["first"]["doc_id"], r["first"]["fine"]) for r in tops)
    # The first row of a piece ends the one above it, which has the larger ids; that of the highest ends the lowest.
    ends = [p for p, _, _ in firsts[1:]] + [p for p, _, _ in firsts[:1]]
    heads = [(i, f, p, to) for (p, i, f), to in zip(firsts, ends, strict=True)]
    halo = docs.sparkSession.createDataFrame(heads, "h_id long, h_fine long, own int, piece int")

    rows = docs.withColumn("fine", _fine())
    own = rows.select("doc_id", "text", "fine", piece.alias("own")).select("*", F.col("own").alias("piece"), F.lit(False).alias("halo"))
    same = F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("fine") == F.col("h_fine"))
    # One for each piece; of rows that are equal in id and hash the one with the least text.
    first = F.min(F.struct("text", "doc_id", "fine", "own")).alias("x")
    copies = rows.join(F.broadcast(halo), same).groupBy("piece").agg(first)
    copies = copies.select("x.doc_id", "x.text", "x.fine", "x.own", "piece", F.lit(True).alias("halo"))

    order = Window.partitionBy("piece").orderBy("halo", F.col("doc_id").desc_nulls_last(), F.col("fine").desc(), "text")
    place = F.when(F.col("halo"), F.lit(1)).otherwise(F.row_number().over(order))
    placed = own.unionByName(copies).withColumn("row", F.shiftleft(F.col("own").cast("long"), _PLACE) + place)
    following = [F.lead("row").over(order).alias("next_row"), F.lead("text").over(order).alias("next_text")]
    return placed.select("row", "doc_id", "text", "halo", *following).filter(~F.col("halo")).drop("halo")


def edited(text: Column, other: Column) -> Column:
    """The text with its last third, in whole characters, replaced by as many of the first ones of ``other``."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(other, F.lit(1), cut))


def document_fingerprints(
    docs: DataFrame,
    queries: Column | None = None,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Fingerprints of every row, of its edited text (see ``edited``, with the next row's text), and their likeness.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` and ``n_within``: for rows
    where ``queries`` (over ``doc_id``) holds, how many other rows have a fingerprint within ``radius`` bits; null
    for others. Null and empty texts have no words and fingerprint zero, and are their own edited texts. Order,
    repeated rows and rows without an id: see ``with_next``. A lone row is followed by itself.
    """
    pairs = with_next(docs, id_col, text_col).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("text"), F.lit(None).cast("string").alias("edited_sha256")),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("text"), F.sha2("edited", 256).alias("edited_sha256")),
    )
    facts = ["row", "next_row", "doc_id", "n_chars", "side", "edited_sha256"]
    versions = pairs.select("row", "next_row", "doc_id", F.length("text").cast("long").alias("n_chars"), F.inline(sides))
    prints = stage(simhash(versions, facts), "prints")

    own, other = prints.filter("side = 0"), prints.filter("side = 1")
    following = own.select(F.col("row").alias("next_row"), F.col("hi").alias("n_hi"), F.col("lo").alias("n_lo"))
    changed = other.select("row", F.col("edited_sha256").alias("e_sha"), F.col("hi").alias("e_hi"), F.col("lo").alias("e_lo"))
    out = own.join(changed, "row").join(following, "next_row")

    asked = own.filter(queries) if queries is not None else own.filter("false")
    classes = stage(own.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n")), "classes")
    total = F.aggregate("found", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    found = search(classes, asked, radius, blocks).groupBy("hi", "lo").agg(F.sum(total).alias("with_itself"))
    here = [F.col(c) for c in ("hi", "lo")]
    out = out.join(found, ["hi", "lo"], "left")
    held = queries if queries is not None else F.lit(False)
    return out.select(
        "doc_id",
        "n_chars",
        F.col("e_sha").alias("edited_sha256"),
        as_text().alias("fingerprint"),
        as_text("e_hi", "e_lo").alias("edited_fingerprint"),
        likeness(*here, F.col("e_hi"), F.col("e_lo")).alias("near_edited"),
        likeness(*here, F.col("n_hi"), F.col("n_lo")).alias("near_next"),
        F.when(held, F.col("with_itself") - 1).alias("n_within"),
    )
