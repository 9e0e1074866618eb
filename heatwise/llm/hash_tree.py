"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

A tree is a list of (region, rack, shard, weight) rows; the weight of a rack or region is
the sum of what is below it.  A key descends: at each level every child draws ln(u) / w,
with u a uniform number from a hash of key and child, and the largest draw wins, so that
a child of weight w is taken with probability w over all weights.  A draw depends on
nothing but the key, the child and the child's weight.  Therefore a key changes its choice
at a level only towards a child that became heavier or away from one that became lighter:
after a change of weights, rows move into or out of subtrees whose weights changed, and
no others.

``grow`` hangs a new shard below the root as a region of its own.  No other weight
changes, so rows move into the new shard only.  ``reweigh`` changes a weight in place:
rows that enter its region are dealt over that region by its weights.

The draws use MD5, which SQL engines share; 52 bits give a double without rounding.
Everything is DataFrame functions; a document costs one hash for each child on its path.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatwise.llm.common import land

BITS = 52
#: Rows of a shard that one numbering group has on average, and copies that one expanding row makes at most.
GROUP, COPIES = 10_000, 4_096

Tree = list[tuple[str, str, int, float]]


def layout(shards: int, regions: int = 4, racks: int = 2, weight: float = 1.0) -> Tree:
    """``shards`` equal shards, numbered from 0, dealt evenly over regions and their racks."""
    leaves = regions * racks
    return [(f"r{s * leaves // shards // racks}", f"k{s * leaves // shards % racks}", s, weight) for s in range(shards)]


def grow(tree: Tree, weight: float = 1.0) -> Tree:
    """``tree`` with one more shard, which is a region of its own; takes rows only into itself."""
    new = max((s for _, _, s, _ in tree), default=-1) + 1
    return [*tree, (f"grown{new}", "k0", new, weight)]


def reweigh(tree: Tree, shard: int, weight: float) -> Tree:
    """``tree`` with another weight of one shard; zero takes it out of service."""
    return [(r, k, s, weight if s == shard else w) for r, k, s, w in tree]


def _levels(tree: Tree) -> list:
    """(path, weight, [(path, weight, [(path, weight, shard)])]): children of weight zero are left out."""
    found: dict[str, dict[str, list]] = {}
    for region, rack, shard, weight in tree:
        if weight > 0:
            found.setdefault(region, {}).setdefault(rack, []).append((f"{region}/{rack}/{shard}", float(weight), shard))
    total = lambda kids: sum(k[1] for k in kids)
    out = [(region, [(f"{region}/{rack}", total(leaves), leaves) for rack, leaves in racks.items()])
           for region, racks in found.items()]
    return [(region, total(racks), racks) for region, racks in out]


def uniform_bits(text: Column) -> Column:
    """The first 52 bits of the MD5 of ``text`` as a long."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _literal(nodes: list, leaf: bool) -> Column:
    below = (lambda x: F.lit(x).cast("int")) if leaf else (lambda x: x)
    return F.array(*[F.struct(F.lit(path).alias("path"), F.lit(weight).alias("weight"), below(kids).alias("below"))
                     for path, weight, kids in nodes])


def _draw(nodes: Column, key: Column) -> Column:
    """What is below the child with the largest draw; equal draws go to the last path."""
    def drawn(child: Column) -> Column:
        u = (uniform_bits(F.concat(key, F.lit("|"), child["path"])) + 0.5) / float(1 << BITS)
        return F.struct((F.log(u) / child["weight"]).alias("draw"), child["path"].alias("path"), child["below"].alias("below"))
    return F.array_max(F.transform(nodes, drawn))["below"]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard (int) of each key; a null key is the empty string, and a tree without weight gives null."""
    levels = _levels(tree)
    if not levels:
        return F.lit(None).cast("int")
    regions = _literal([(r, rw, _literal([(k, kw, _literal(leaves, True)) for k, kw, leaves in racks], False))
                        for r, rw, racks in levels], False)
    key = F.coalesce(key.cast("string"), F.lit(""))
    return _draw(_draw(_draw(regions, key), key), key)


def place(docs: DataFrame, tree: Tree, grown: Tree | None = None, overhead: int = 16,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, grown_shard: one row per row of ``docs``.

    ``size`` is the text's UTF-8 bytes (null: none) plus ``overhead``; ``slot`` numbers the
    rows of a shard from 0 without gaps, by a hash of (doc_id, size, text_crc32), then by
    these; ``grown_shard`` is the shard in the tree ``grown``, null without one.

    The id decides alone: a null id is a key like any other, rows that repeat an id share
    its shard.  Rows that agree in id, size and checksum are counted before the shuffle
    and expanded after the numbering, in parts, so copies in any number cross as one row.
    Rows are numbered by groups of (shard, hash range), whose count follows the count of
    rows; a group's first slot is a running sum over the groups.  Further columns are left
    out, whatever their names; an empty table gives no rows.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "text_crc32")
    counted = land(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
                   .withColumn("order", uniform_bits(key)).withColumn("shard", shard_of(F.col("doc_id"), tree))
                   .withColumn("grown_shard", F.lit(None).cast("int") if grown is None else shard_of(F.col("doc_id"), grown)),
                   "placed")
    ranges = max(0, math.ceil(math.log2(max(1, counted.count() / GROUP / max(1, len(tree))))))
    counted = counted.withColumn("range", F.shiftright("order", BITS - min(ranges, BITS)))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (counted.groupBy("shard", "range").agg(F.sum("copies").alias("rows"))
              .select("shard", "range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first")))
    inside = (Window.partitionBy("shard", "range").orderBy("order", "doc_id", "size", "text_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    numbered = (counted.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
                .join(firsts, ["shard", "range"]).withColumn("from", F.col("first") + F.col("inside")))
    last = F.col("from") + F.col("copies") - 1
    parts = (numbered.withColumn("at", F.explode(F.sequence(F.col("from"), last, F.lit(COPIES).cast("long"))))
             .withColumn("to", F.least(F.col("at") + COPIES - 1, last))
             .select("doc_id", "size", "text_crc32", "shard", "grown_shard", "at", "to").repartition("shard", "at"))
    return parts.select("doc_id", "size", "text_crc32", "shard", F.explode(F.sequence("at", "to")).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, tree: Tree, path: str, rows_per_file: int = 100_000, id_col: str = "doc_id",
                 shard_col: str = "shard") -> None:
    """Write ``docs`` below ``path``, one folder per shard, in files of about ``rows_per_file`` rows.

    A column of ``docs`` named ``shard_col`` is replaced.  A shard's rows are dealt over
    its files by a hash of all that can be hashed, so a hot id fills files like others.
    """
    files = max(1, math.ceil(docs.count() / rows_per_file / max(1, len(tree))))
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    out = docs.withColumn(shard_col, shard_of(F.col(f"`{id_col}`"), tree))
    salt = F.pmod(F.xxhash64(*plain), F.lit(files))
    out.repartition(max(1, len(tree)) * files, F.col(f"`{shard_col}`"), salt).write.partitionBy(shard_col).parquet(path)
