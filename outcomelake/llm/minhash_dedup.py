"""Operator 2: near-duplicate documents by bottom-k sketches from one hash function.

A document keeps the smallest hashes of its shingles.  Inverted lists of the kept values
propose pairs, the sketch of a pair's union estimates its similarity and drops what is far
off, and the full sets of both texts decide.

Three things keep lists short.  Equal sets are one class from the start.  A first round ties
every document only to the least of its lists; what that confirms is a component, and the
second round compares across components only.  The second round's lists are of two
neighbouring values, the same for every document however many others hold them; members of
long lists meet by their rarest shingles instead, which loses nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelake.llm.common import append_columns, discard, materialize, mix, numbered, stored, windows, word_ids
from outcomelake.llm.components import components

#: Values of a sketch, those that propose pairs, and those of the first round.
STORED, PROPOSING, FIRST = 48, 24, 3
#: Pairs whose estimate is below this share of the threshold are dropped.
FAR_OFF = 0.5
#: Members from which on a list is long, documents of a block, columns of a matrix.
SHORT, BLOCK, COLUMNS = 16, 128, 4096


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``width`` words, A-Z lower-cased.

    Fewer words are one shingle; no words, none.
    """
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(mix(windows(word_ids(words), min(width, len(words)))))


def sketch(docs: DataFrame, width: int, text: str = "text") -> DataFrame:
    """``doc_id``, a hash of the text, the size of the set, two hashes of the whole set, and its ``STORED`` smallest values."""
    long = T.LongType()
    fields = [T.StructField("n_shingles", long), T.StructField("h1", long), T.StructField("h2", long), T.StructField("sketch", T.ArrayType(long))]

    def fill(columns: dict[str, pa.Array]) -> list[pa.Array]:
        sets = [shingles(v.as_py(), width) for v in columns[text]]
        digests = np.array([(d >> 64, d & (1 << 64) - 1) for d in (xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets)], np.uint64).reshape(-1, 2)
        return [
            pa.array([len(s) for s in sets], pa.int64()), *[pa.array(digests[:, k].astype(np.int64)) for k in (0, 1)],
            # Read as signed numbers; moving the sign bit keeps their order.
            pa.array([(s[:STORED] ^ np.uint64(1 << 63)).astype(np.int64) for s in sets], pa.list_(pa.int64())),
        ]

    return append_columns(docs.select("doc_id", text, F.xxhash64(text).alias("t")), fields, fill, [text], ["doc_id", "t"])


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (``u``, ``v``) whose sizes and union sketch leave the threshold in reach.

    The smallest values of the union are a random sample of it; the share of them that
    both sketches hold estimates the similarity.  The margin is wide: for a pair at
    the threshold the chance to fall below is under 1e-9.
    """
    side = lambda name: classes.select(
        F.col("rep").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))
    small, large = F.least("n_u", "n_v"), F.greatest("n_u", "n_v")
    union = F.slice(F.array_sort(F.array_union("s_u", "s_v")), 1, STORED)
    both = F.size(F.array_intersect(F.array_intersect("s_u", "s_v"), union))
    sized = pairs.join(classes.select(F.col("rep").alias("u"), F.col("n").alias("n_u")).distinct(), "u") \
        .join(classes.select(F.col("rep").alias("v"), F.col("n").alias("n_v")).distinct(), "v") \
        .where(100 * small >= percent * large).select("u", "v").distinct()
    return (
        sized.join(side("u"), "u").join(side("v"), "v").where(100 * small >= percent * large)
        .where(100 * both >= FAR_OFF * percent * F.size(union)).select("u", "v").distinct()
    )


def _texts(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, str]:
    """Id and text of the documents among ``ids``, with other columns of those, and the path of that table.

    The ids grow with the input, so this is a join by shuffle at every size.
    """
    wanted = ids.distinct().hint("merge")
    return stored(docs.select(F.col("doc_id").alias("id"), "text").join(wanted, "id"), "wanted-texts")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("id")).union(pairs.select("v"))


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    joined = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("t_u")), "u") \
        .join(texts.select(F.col("id").alias("v"), F.col("text").alias("t_v")), "v")

    def fill(columns: dict[str, pa.Array]) -> list[pa.Array]:
        known: dict[str, np.ndarray] = {}
        out = []
        for a, b in zip(columns["t_u"].to_pylist(), columns["t_v"].to_pylist()):
            x, y = (known[t] if t in known else known.setdefault(t, shingles(t, width)) for t in (a, b))
            shared = len(np.intersect1d(x, y, assume_unique=True))
            out.append(shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
        return [pa.array(out, pa.bool_())]

    checked = append_columns(joined, [T.StructField("linked", T.BooleanType())], fill, ["t_u", "t_v"], ["u", "v"])
    return materialize(checked.where("linked").select("u", "v").distinct(), "links")


def _first_pairs(classes: DataFrame) -> DataFrame:
    """Every document with the least one that shares one of its smallest values: linear in the number of documents."""
    values = classes.select("rep", F.explode(F.slice("sketch", 1, FIRST)).alias("value"))
    least = values.groupBy("value").agg(F.min("rep").alias("u"), F.max("rep").alias("most")).where("u < most")
    return values.join(least.select("value", "u"), "value").where("u < rep").select("u", F.col("rep").alias("v")).distinct()


def _keys(values: Column) -> Column:
    """A key for each two neighbours of an ordered array; of an array of one, for that."""
    two = F.transform(
        F.sequence(F.lit(1), F.size(values) - 1),
        lambda i: F.xxhash64(F.element_at(values, i), F.element_at(values, i + 1)))
    return F.when(F.size(values) > 1, two).when(F.size(values) == 1, F.array(F.xxhash64(F.element_at(values, 1)))).otherwise(
        F.array().cast("array<bigint>"))


def _second_links(classes: DataFrame, tied: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """All links across components, of pairs that share two neighbouring proposing values and have sizes within reach.

    Pairs of short lists are rows.  The members of long lists, families of texts that are
    alike but mostly not linked, meet again in lists of their rarest shingles; what shares
    even those with many is cut into blocks, and tasks compare two blocks at a time.
    """
    spark = docs.sparkSession
    placed = materialize(
        classes.join(tied.withColumnRenamed("node", "rep"), "rep", "left")
        .select("rep", "n", "sketch", F.coalesce("component", "rep").alias("comp")), "placed")
    # All documents propose by the same rule: a key that one side leaves out meets nothing on the other.
    keys = _keys(F.slice("sketch", 1, PROPOSING))
    proposing, all_keys = stored(placed.select("rep", "n", "comp", F.explode(F.array_distinct(keys)).alias("key")), "proposing")
    rows, mixed_keys = _mixed(proposing, "proposing-mixed")
    discard(spark, all_keys)
    pairs = _short_pairs(rows, percent)
    family = _family(rows.where(F.col("members") > SHORT), placed, percent)
    pairs = materialize(_near(pairs, classes, percent), "pairs")
    discard(spark, mixed_keys)
    wanted = _ends(pairs).select("id", F.lit(None).cast(dict(family.dtypes)["comp"]).alias("comp")) \
        .union(family.select("rep", "comp")).groupBy("id").agg(F.max("comp").alias("comp"))
    texts, path = _texts(docs, wanted)
    rare, rare_path = _rare_lists(texts, width, percent)
    rare_pairs = materialize(_near(_short_pairs(rare, percent), classes, percent), "pairs")
    long_rows = rare.where(F.col("members") > SHORT)
    blocks = _family_blocks(long_rows)
    near, members, scratch = _near_members(long_rows, blocks, placed, percent)
    links = _confirmed(pairs.union(rare_pairs).distinct(), texts, width, percent).union(_block_links(near, members, texts, width, percent))
    for old in (path, rare_path, *scratch):
        discard(spark, old)
    return links


def _mixed(proposing: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The rows of lists (``key``) that hold more than one component, with their number of ``members``, and the path of that table."""
    mixed = proposing.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.count(F.lit(1)).alias("members")) \
        .where("a < b").select("key", "members")
    return stored(proposing.join(mixed, "key"), label)


def _short_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs across components of the lists that are not long."""
    short = rows.where(F.col("members") <= SHORT)
    a = short.select("key", F.col("rep").alias("u"), F.col("n").alias("n_u"), F.col("comp").alias("c_u"))
    b = short.select("key", F.col("rep").alias("v"), F.col("n").alias("n_v"), F.col("comp").alias("c_v"))
    sized = (100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))
    return a.join(b, "key").where((F.col("u") < F.col("v")) & (F.col("c_u") != F.col("c_v")) & sized).select("u", "v").distinct()


def _family(rows: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """``rep`` and ``comp`` of the members of long lists that share enough of their sketch with other components to be near any."""
    values = placed.join(rows.select("rep").distinct(), "rep").select(
        "rep", "comp", F.size("sketch").alias("stored"), F.explode("sketch").alias("key"))
    values, path = stored(values, "family-values")
    mixed = values.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a < b").select("key")
    # Texts of one id count together, which only keeps more.
    found = values.join(mixed, "key").groupBy("rep", "comp").agg(F.count(F.lit(1)).alias("held"), F.min("stored").alias("stored")) \
        .where(100 * F.col("held") >= FAR_OFF * percent * F.col("stored")).select("rep", "comp")
    found = materialize(found, "family")
    discard(rows.sparkSession, path)
    return found


def _rare_lists(texts: DataFrame, width: int, percent: int) -> tuple[DataFrame, str]:
    """Lists (``key``) of the rarest shingles of the texts that have a ``comp``, and the path of that table.

    A text of n shingles links only with one that shares at least percent * n / 100 of them.
    In one order of all shingles, first those of a single component, then by the number of
    texts that hold them, two linked texts share one of the first n - percent * n / 100 + 1 of
    either: nothing is lost.  Texts whose own shingles fill those places leave here, and a
    passage that many share makes no list unless it is nearly all of a text.
    """
    def fill(columns: dict[str, pa.Array]) -> list[pa.Array]:
        sets = [shingles(v.as_py(), width) for v in columns["text"]]
        return [pa.array([len(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]

    family = texts.where("comp is not null").select(F.col("id").alias("rep"), "comp", F.xxhash64("text").alias("t"), "text")
    fields = [T.StructField("n", T.LongType()), T.StructField("values", T.ArrayType(T.LongType()))]
    sets, path = stored(append_columns(family, fields, fill, ["text"], ["rep", "comp", "t"]), "family-sets")
    common = sets.select("comp", F.explode("values").alias("key")).groupBy("key") \
        .agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.count(F.lit(1)).alias("texts")).where("a < b").select("key", "texts")
    held = sets.select("rep", "comp", "t", "n", F.explode("values").alias("key")).join(common, "key") \
        .groupBy("rep", "comp", "t", "n").agg(F.array_sort(F.collect_set(F.struct("texts", "key"))).alias("held"))
    needed = F.ceil(percent * F.col("n") / 100)
    first = held.where(F.size("held") >= needed).select(
        "rep", "comp", "n", F.explode(F.slice("held", 1, (F.size("held") - needed + 1).cast("int"))).alias("s"))
    rare, rare_path = stored(first.select("rep", "comp", "n", F.col("s.key").alias("key")), "rare")
    lists = _mixed(rare, "rare-mixed")
    for old in (path, rare_path):
        discard(texts.sparkSession, old)
    return lists


def _family_blocks(rows: DataFrame) -> DataFrame:
    """The members of long lists with their blocks of at most ``BLOCK``, in the order of their least keys; components stay together."""
    whole = rows.groupBy("comp").agg(F.min("key").alias("least"), F.min("n").alias("low"))
    single = rows.groupBy("rep", "comp").agg(F.min("n").alias("n")).join(whole, "comp")
    members = numbered(single, ["least", "low", "comp", "n", "rep"], "family-order")
    return materialize(members.select("rep", F.floor(F.col("number") / BLOCK).alias("block")), "family-blocks")


def _near_members(rows: DataFrame, blocks: DataFrame, placed: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """The members of two blocks, or of one, whose sketches come near another's there; all members; paths of both tables.

    Only sketches travel to the tasks that compare blocks, so that texts are fetched where they decide.
    """
    members, own = stored(blocks.join(placed.select("rep", "comp", "n", "sketch"), "rep"), "family-sketches")
    # Lists of one family mostly meet in the same blocks: distinct sets of blocks come first, then their pairs.
    sets = rows.join(blocks, "rep").groupBy("key").agg(F.array_sort(F.collect_set("block")).alias("met")).select("met").distinct()
    meeting = sets.select(F.explode("met").alias("x"), "met").select("x", F.explode("met").alias("y")).where("x <= y").distinct()
    ranges = members.groupBy("block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("comp").alias("one"), F.max("comp").alias("other"))
    side = lambda name: ranges.select(F.col("block").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("low", "high", "one", "other")])
    reach = (100 * F.col("high_x") >= percent * F.col("low_y")) & (100 * F.col("high_y") >= percent * F.col("low_x"))
    # Two blocks of one and the same component have nothing to find.
    same = (F.col("one_x") == F.col("other_x")) & (F.col("one_y") == F.col("other_y")) & (F.col("one_x") == F.col("one_y"))
    meeting = meeting.join(side("x"), "x").join(side("y"), "y").where(reach & ~same).select("x", "y")
    sides = meeting.select("x", "y", F.col("x").alias("block")).union(meeting.where("x < y").select("x", "y", "y"))

    def find(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("rep").reset_index(drop=True)
        return group.loc[_near_matrix(group, percent).any(axis=1), ["x", "y", "rep"]]

    kind = dict(blocks.dtypes)["rep"]
    near, found = stored(sides.join(members, "block").groupBy("x", "y").applyInPandas(find, f"x long, y long, rep {kind}"), "family-near")
    return near, members, [own, found]


def _block_links(near: DataFrame, members: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links among the members of long lists: a task compares the texts of what is near in two blocks."""

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        return _links_of_blocks(group, width, percent)

    full = near.join(members, "rep").join(texts.select(F.col("id").alias("rep"), "text"), "rep")
    kind = dict(members.dtypes)["rep"]
    return materialize(full.groupBy("x", "y").applyInPandas(compare, f"u {kind}, v {kind}"), "family-links")


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sets share, by products of 0/1 matrices of some columns at a time."""
    values, times = np.unique(np.concatenate(sets), return_counts=True)
    values = values[times > 1]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    every = np.concatenate(sets)
    at = np.searchsorted(values, every)
    held = at < len(values)
    held[held] = values[at[held]] == every[held]
    owner, at = owner[held], at[held]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for first in range(0, len(values), COLUMNS):
        a, b = np.searchsorted(at, [first, first + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, len(values) - first)), np.float32)
        part[owner[a:b], at[a:b] - first] = 1
        out += (part @ part.T).astype(np.int64)
    return out


def _near_matrix(group: pd.DataFrame, percent: int) -> np.ndarray:
    """Which two members of different components, and of both blocks where there are two, may link by size and sketch."""
    sketches = [np.asarray(s, np.int64) for s in group["sketch"]]
    size = group["n"].to_numpy()
    stored = np.array([len(s) for s in sketches])
    block, comp = (group[c].to_numpy() for c in ("block", "comp"))
    near = 100 * np.minimum.outer(size, size) >= percent * np.maximum.outer(size, size)
    near &= comp[:, None] != comp[None, :]
    if (block != block[0]).any():
        near &= block[:, None] != block[None, :]
    return near & (100 * _shared(sketches) >= FAR_OFF * percent * np.maximum.outer(stored, stored))


def _links_of_blocks(group: pd.DataFrame, width: int, percent: int) -> pd.DataFrame:
    """A forest of the links between two blocks, or within one; ids are of any type."""
    group = group.drop_duplicates(["rep", "text"]).reset_index(drop=True)
    near = _near_matrix(group, percent)
    used = np.flatnonzero(near.any(axis=1))
    rep = group["rep"].tolist()
    parent = {rep[k]: rep[k] for k in used}
    out = []

    def root(k: object) -> object:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    if len(used):
        sets = [shingles(t, width) for t in group["text"].iloc[used]]
        shared, length = _shared(sets), np.array([len(s) for s in sets])
        linked = near[np.ix_(used, used)] & (shared > 0) & (100 * shared >= percent * (length[:, None] + length[None, :] - shared))
        for i, j in zip(*np.nonzero(np.triu(linked))):
            u, v = rep[used[i]], rep[used[j]]
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((u, v))
    return pd.DataFrame(out, columns=["u", "v"])


def _marked(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """What ``near_duplicates`` returns, with the hash ``t`` of each row's text."""
    docs = docs.select("doc_id", "text")
    all_rows = materialize(sketch(docs, width), "sketches")
    classes = materialize(
        all_rows.where("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2")
        .agg(F.min_by(F.struct("n_shingles", "sketch"), "doc_id").alias("s"), F.min("doc_id").alias("rep"))
        .select("h1", "h2", "rep", F.col("s.n_shingles").alias("n"), F.col("s.sketch").alias("sketch")), "classes")
    pairs = materialize(_near(_first_pairs(classes), classes, percent), "pairs")
    texts, path = _texts(docs, _ends(pairs))
    first = _confirmed(pairs, texts, width, percent)
    discard(docs.sparkSession, path)
    second = _second_links(classes, components(first), docs, width, percent)
    found = components(first.union(second))
    groups = classes.select("h1", "h2", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("h1", "h2", F.coalesce("component", "rep").alias("component"))
    out = all_rows.select("doc_id", "t", "n_shingles", "h1", "h2").join(groups, ["h1", "h2"], "left").select(
        "doc_id", "t", "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Documents link when shared shingles are at least ``percent`` hundredths of all of both;
    equal sets always do.  Null and empty texts have no shingles and link with
    nothing.  Rows that share an id each go by their own text.  Rows of null id link
    with nothing: ``component_id`` is null and ``kept`` true.  Other columns are not used.

    Completeness: a linked pair of sets of up to ``STORED`` shingles, at 80 percent and more,
    always shares two neighbouring values.  Of larger sets a pair right at the threshold has
    no two neighbours in common among its ``PROPOSING`` smallest values with a chance of
    4.9e-9 at 85 and 1.7e-7 at 80 percent where one text is the other with additions, and
    4.3e-11 and 2.5e-9 where both differ alike (exact, for large sets); above the threshold it is less.
    """
    return _marked(docs, width, percent).drop("t")


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, that of the least id, with its own columns.

    Of rows equal in id and text one stays, rows of null id all stay.
    """
    marks = _marked(docs, width, percent).where("not kept").select(F.col("doc_id").alias("__gone"), F.col("t").alias("__text")).distinct()
    hashed = docs.withColumn("__t", F.xxhash64("text"))
    gone = (F.col("doc_id") == F.col("__gone")) & (F.col("__t") == F.col("__text"))
    rest = hashed.where("doc_id is not null").join(marks, gone, "left_anti").dropDuplicates(["doc_id", "__t"])
    return rest.select(*docs.columns).union(docs.where("doc_id is null"))
