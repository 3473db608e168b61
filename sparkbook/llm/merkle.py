"""Merkle manifest of a table, with proofs by pointer jumping.

Every document is a leaf: the hash of its framed fields. Leaves are numbered
per language by ascending doc_id, runs of two are hashed level by level to one
subroot per language, and the subroots, by language, to the root.

The tree is built ``STEP`` levels at a time: a block of 2**STEP neighbours is one
row of a grouped array, so a language with any share of the rows is split into
blocks and a round shrinks the nodes 2**STEP times. Each node is written with its sibling.

A proof is found by pointer jumping. A node holds a segment (the siblings on
the way to an ancestor, 33 bytes a level: side and digest) and a pointer to that
ancestor. A self-join on the pointer appends the ancestor's segment and takes
its pointer, which doubles the distance; after log2(height) joins every leaf has
reached the root. At distance d only nodes whose level is a multiple of d can be
pointed at, so the side that is joined shrinks with d: what all leaves share is
small when they share it.

Defined cases: a null field is framed as ``-``, in doc_id too; null doc_ids come
first, are never tampered with, and equal doc_ids are ordered by their leaf;
rows repeated in full are leaves of their own; an empty table has no rows and
no root; a table of one row has its leaf as root and an empty proof; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbook.llm.common import dropped, saved
from sparkbook.operators.scan import numbered

#: Levels built per round.
STEP = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the subroots; languages are numbered from 0.
TOP = -1
LEFT, RIGHT, ALONE = "00", "01", "02"


def framed(*values: Column) -> Column:
    """Each value as byte count, colon, value, or ``-`` where it is null."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (v.cast("string") for v in values)]
    return F.concat(*parts)


def leaf_hash(n_chars: Column | None = None) -> Column:
    return F.sha2(framed(*[n_chars if c == "n_chars" and n_chars is not None else F.col(c) for c in FIELDS]).cast("binary"), 256)


def picked(every: int) -> Column:
    """Whether ``every`` divides the unsigned crc32 of the decimal doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))


def height(size: Column) -> Column:
    """Levels above ``size`` leaves until one node is left."""
    return F.when(size > 1, F.length(F.bin(size - 1))).otherwise(0).cast("int")


def _pairs(nodes: Column) -> Column:
    """The level above an array of digests."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.concat(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))).cast("binary"), 256))


def _sibling(nodes: Column, i: Column) -> Column:
    """33 bytes: side and digest of node ``i``'s sibling, zeros where it has none."""
    left = F.concat(F.lit(LEFT), F.get(nodes, i - 1))
    right = F.coalesce(F.concat(F.lit(RIGHT), F.get(nodes, i + 1)), F.lit(ALONE + "00" * 32))
    return F.unhex(F.when(i % 2 == 1, left).otherwise(right))


def tree(leaves: DataFrame, step: int = STEP) -> DataFrame:
    """(tree, level, idx, digest, sibling) of every node above (tree, idx, digest, height); the root has no sibling.

    A round groups 2**step neighbours, folds the levels of the block and hands
    its top node to the next round; it ends when no tree has levels left.
    """
    base, at, rounds, previous = 0, leaves, [], None
    while True:
        block = F.array_sort(F.collect_list(F.struct("idx", "digest")))
        blocks = at.groupBy("tree", "height", F.shiftright("idx", step).alias("block")).agg(block.alias("b"))
        ups = F.least(F.lit(step), F.greatest(F.col("height") - base, F.lit(0)))
        levels = F.aggregate(F.sequence(F.lit(1), F.lit(step)), F.array(F.transform("b", lambda n: n["digest"])),
                             lambda acc, k: F.when(k <= ups, F.concat(acc, F.array(_pairs(F.element_at(acc, -1))))).otherwise(acc))
        done = saved(blocks.select("tree", "height", "block", ups.alias("ups"), levels.alias("levels")), f"tree-{base}")
        each = done.select("tree", "height", "block", "ups", F.posexplode("levels").alias("up", "nodes"))
        each = each.select("tree", "height", "block", "up", "ups", "nodes", F.posexplode("nodes").alias("i", "digest"))
        level, idx = F.col("up") + base, F.expr(f"shiftright(shiftleft(block, {step}), up)") + F.col("i")
        # A block's top node is the next round's leaf, unless it is the root.
        rounds.append(each.filter((F.col("up") < F.col("ups")) | (level == F.col("height"))).select(
            "tree", level.alias("level"), idx.alias("idx"), "digest", F.when(level < F.col("height"), _sibling(F.col("nodes"), F.col("i"))).alias("sibling")))
        base += step
        at = done.filter(F.col("height") > base).select("tree", "height", F.col("block").alias("idx"), F.element_at(F.element_at("levels", -1), 1).alias("digest"))
        if at.isEmpty():
            break
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)
    return out


def climbed(nodes: DataFrame, steps: int) -> DataFrame:
    """(tree, idx, path) of every leaf: the siblings from it to the root, by pointer jumping over ``steps`` steps at most.

    ``nodes``: tree, level, idx, sibling and the pointer up_tree, up_level, up_idx, null at the root.
    """
    up = ["up_tree", "up_level", "up_idx"]
    jumps = saved(nodes.select("tree", "level", "idx", *up, F.coalesce("sibling", F.lit(b"")).alias("path")), "jumps")
    leaf = (F.col("level") == 0) & (F.col("tree") != TOP)
    distance = 1
    while distance < steps:
        # Pointed at are the nodes this distance above a leaf, and those of the tree over the subroots.
        target = jumps.filter((F.col("level") > 0) | (F.col("tree") == TOP)).select(
            F.col("tree").alias("t"), F.col("level").alias("l"), F.col("idx").alias("i"), *[F.col(c).alias(f"far_{c}") for c in up], F.col("path").alias("rest"))
        keep = jumps.filter((F.col("level") % (2 * distance) == 0) | (F.col("tree") == TOP))
        going = keep.filter("up_tree is not null").join(target, (F.col("up_tree") == F.col("t")) & (F.col("up_level") == F.col("l")) & (F.col("up_idx") == F.col("i")))
        going = going.select("tree", "level", "idx", *[F.col(f"far_{c}").alias(c) for c in up], F.concat("path", "rest").alias("path"))
        longer = saved(going.unionByName(keep.filter("up_tree is null")), "jumps")
        dropped(jumps)
        jumps, distance = longer, 2 * distance
    return jumps.filter(leaf).select("tree", "idx", "path")


def _level(i: Column) -> tuple[Column, Column]:
    """Side and digest of step ``i`` of ``path``."""
    at = F.hex(F.substring(F.col("path"), 33 * i + 1, F.lit(33)))
    return F.substring(at, 1, 2), F.lower(F.substring(at, 3, 64))


def _steps() -> Column:
    """0, 1, ... for each step of ``path``; none for an empty one."""
    n = F.floor(F.octet_length("path") / 33).cast("int")
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _proof() -> Column:
    def one(i: Column) -> Column:
        side, digest = _level(i)
        return F.when(side == ALONE, F.lit("")).otherwise(digest)

    return F.sha2(F.array_join(F.transform(_steps(), one), "").cast("binary"), 256)


def _folded(leaf: Column) -> Column:
    """The root that ``path`` gives over ``leaf``."""

    def up(acc: Column, i: Column) -> Column:
        side, digest = _level(i)
        both = F.when(side == LEFT, F.concat(digest, acc)).when(side == RIGHT, F.concat(acc, digest)).otherwise(acc)
        return F.sha2(both.cast("binary"), 256)

    return F.aggregate(_steps(), leaf, up)


def manifest(docs: DataFrame, tamper: Column | None = None, step: int = STEP) -> DataFrame:
    """(doc_id, lang, leaf, subroot, root, path, proof_sha256, folded_root, verified) of every document.

    ``path`` is the proof: 33 bytes a level. Where ``tamper`` holds, 1 is added to
    n_chars before the leaf is folded; everything else is the untampered tree.
    """
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    shown = F.when(tamper, leaf_hash(more)).otherwise(leaf_hash()) if tamper is not None else leaf_hash()
    hashed = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), leaf_hash().alias("leaf"), shown.alias("shown")), "leaves")
    sizes = hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    langs = saved(numbered(sizes, [], ["lang"], "tree").select(F.col("lang").alias("of"), "tree", height(F.col("size")).alias("height")), "languages")
    count, tallest = langs.agg(F.count(F.lit(1)), F.coalesce(F.max("height"), F.lit(0))).first()

    placed = numbered(hashed, ["lang"], ["doc_id", "leaf"], "idx").join(langs, F.col("lang").eqNullSafe(F.col("of")))
    placed = saved(placed.select("doc_id", "lang", "leaf", "shown", "tree", "idx", "height"), "placed")
    dropped(hashed)
    lower = tree(placed.select("tree", "idx", F.col("leaf").alias("digest"), "height"), step).join(langs.select(F.col("tree").alias("in"), "height"), F.col("tree") == F.col("in"))
    subroots = saved(lower.filter(F.col("level") == F.col("height")).select("tree", F.col("digest").alias("subroot")), "subroots")
    top_height = (count - 1).bit_length() if count else 0
    upper = saved(tree(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("subroot").alias("digest"), F.lit(top_height).alias("height")), step), "top")
    root = upper.filter(F.col("level") == top_height).select("digest").first()

    # A subroot goes on as the leaf of the upper tree that it is.
    out = F.col("level") == F.col("height")
    pointer = [F.when(out, TOP).otherwise(F.col("tree")), F.when(out, 0).otherwise(F.col("level") + 1), F.when(out, F.col("tree")).otherwise(F.shiftright("idx", 1))]
    below = lower.select("tree", "level", "idx", "sibling", *[p.cast(k).alias(c) for p, k, c in zip(pointer, ("long", "int", "long"), ("up_tree", "up_level", "up_idx"), strict=True)])
    more_up = F.col("level") < top_height
    above = upper.select("tree", "level", "idx", "sibling", F.when(more_up, F.col("tree")).alias("up_tree"), F.when(more_up, F.col("level") + 1).alias("up_level"), F.when(more_up, F.shiftright("idx", 1)).alias("up_idx"))
    paths = climbed(below.unionByName(above), tallest + 1 + top_height + 1)

    proven = placed.join(paths.select(F.col("tree").alias("t"), F.col("idx").alias("i"), "path"), (F.col("tree") == F.col("t")) & (F.col("idx") == F.col("i")))
    proven = proven.join(subroots.withColumnRenamed("tree", "s"), F.col("tree") == F.col("s"))
    top = F.lit(root["digest"] if root else None).cast("string")
    proven = proven.select("doc_id", "lang", "leaf", "subroot", top.alias("root"), "path", _proof().alias("proof_sha256"), _folded(F.col("shown")).alias("folded_root"))
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_report(docs: DataFrame) -> DataFrame:
    """The manifest with the documents tampered with whose doc_id's crc32 7 divides."""
    return manifest(docs, picked(7)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _frame_sql(n_chars: str = "n_chars") -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(({c})::varchar) || ':' || ({c})::varchar, '-')" for c in (n_chars if c == "n_chars" else c for c in FIELDS)) + ")"


#: The bitwise crc32 of a decimal string, before the last complement; the polynomial is a fixed value.
_CRC = """list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ord(substr(doc_id::varchar, i, 1))::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))"""
_ABOVE = "list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))"

#: DuckDB SQL for manifest_report() over the table documents.
SQL = f"""
with recursive h as (
  select doc_id, lang, {_frame_sql()} as leaf,
         case when xor({_CRC}, 4294967295) % 7 = 0 then {_frame_sql("n_chars + 1")} else {_frame_sql()} end as shown
  from documents
),
p as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx, row_number() over () as r from h),
t as (
  select lang, 0 as level, list(leaf order by idx) as nodes from p group by lang
  union all
  select lang, level + 1, {_ABOVE} from t where len(nodes) > 1
),
s as (select lang, nodes[1] as subroot, level as height, row_number() over (order by lang nulls first) - 1 as idx from t where len(nodes) = 1),
u as (
  select 0 as level, list(subroot order by idx) as nodes from s
  union all
  select level + 1, {_ABOVE} from u where len(nodes) > 1
),
w as (
  select r, level as step, nodes[xor(idx >> level, 1) + 1] as sibling, (idx >> level) & 1 as on_left from p join t on p.lang is not distinct from t.lang where len(nodes) > 1
  union all
  select r, s.height + u.level, u.nodes[xor(s.idx >> u.level, 1) + 1], (s.idx >> u.level) & 1 from p join s on p.lang is not distinct from s.lang, u where len(u.nodes) > 1
),
k as (select r, string_agg(sibling, '' order by step) as proof, list({{'x': sibling, 'on_left': on_left}} order by step) as steps from w group by r),
f as (
  select p.doc_id, p.leaf, s.subroot, (select nodes[1] from u where len(nodes) = 1) as root, sha256(coalesce(k.proof, '')) as proof_sha256,
         list_reduce(list_prepend({{'x': p.shown, 'on_left': 0::bigint}}, coalesce(k.steps, [])),
                     lambda a, b: {{'x': sha256(case when b.x is null then a.x when b.on_left = 1 then b.x || a.x else a.x || b.x end), 'on_left': 0::bigint}}).x as folded_root
  from p join s on p.lang is not distinct from s.lang left join k on p.r = k.r
)
select *, folded_root = root as verified from f
"""
