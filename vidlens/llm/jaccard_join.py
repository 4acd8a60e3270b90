"""N-gram Jaccard join with pivots (operator 2).

Texts are sets of word shingles, and the Jaccard distance 1 - J is a metric.
Equal sets are one class from the start. Distances between unrelated texts
are all 1, so cells around pivots drawn at random would hold everything;
pivots are therefore taken where texts meet. All shingles have one global
order, rare ones first. Two sets within the threshold share a shingle among
the first few of each, and their sizes differ by the threshold at most. So the
sets that have a shingle there and sizes of one band form a region, boundary
sets are replicated to the band below, and every link lies within some region.

Regions are then joined recursively and exactly. In each region:

1. Pivot: the set that is in most regions. Regions of the same sets are one. Every set of the region is compared with it.
   Sets within the threshold link to the pivot; they are its cell.
2. Two sets of one cell are joined through the pivot. Sets below the similarity ``FAR``,
   more than twice the threshold distance away, link with none of it; they choose the next pivot, in
   a region of their own to which the sets at the cell's boundary are replicated
   that the triangle inequality's window reaches.
   Distances are first bounded on profiles, the numbers of shingles by hash
   range, whose weighted Jaccard distance is never above the sets' distance;
   whole sets are sent only where that does not prove them far.
3. For pairs of the sets nearer than that, let the difference of a set be the
   shingles that it or the pivot has, but not both.
   The distance of two sets is told by their differences, and where not both
   are within the threshold of the pivot, a link needs differences with a large
   common part (``least_common``); it follows that they share a shingle among
   the first of each difference, in an order that is the same for all.
   The sets that share one there are regions of the next level. Edits that no two texts share leave no
   region, however many texts there are around a pivot.
4. Regions whose sets are all joined already are left out. Regions of up to ``FEW``
   sets are not split further, nor are any when all larger ones together have no more
   pairs than the table has classes: their pairs, and those of regions left after the
   last level, are compared one by one, where sizes, places and profiles allow a link.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.llm.common import SHUFFLE_CLEANUP, arrow_rows, connected_components, discard, materialize, setting, table
from vidlens.llm.lm_scoring import slices
from vidlens.llm.words import mix, released, word_hashes

LEAD = 8
LEVELS = 5
# A region of up to this many sets is compared pair by pair.
FEW = 8
# Sets less similar than this to a pivot, in percent, go on with the next one instead of by their differences.
FAR = 40
BROADCAST_ROWS = 500_000
COMMON_SHARE = 2000
MAX_COMMON = 2_000_000
# Bounds on what a Python worker holds at once: text bytes worked on, rows of whole sets sent.
PART_BYTES = 2 << 20
SET_ROWS = 1000


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of each text, sorted; first of each text and the total at the end).

    A text with fewer than k words, but some, has its whole sequence as one shingle.
    """
    words, first = word_hashes(texts)
    n_words = np.diff(first)
    n = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    start = np.cumsum(n) - n
    row = np.repeat(np.arange(len(n)), n)
    at = np.repeat(first[:-1] - start, n) + np.arange(int(n.sum()))
    length = np.minimum(n_words, k)[row]
    h = mix(length.astype(np.uint64))
    whole = bool(len(length)) and int(length.min()) == k
    for j in range(k if len(words) else 0):
        longer = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[at + j if whole else np.minimum(at + j, len(words) - 1)])
        h = longer if whole else np.where(j < length, longer, h)
    for a, b in zip(start.tolist(), (start + n).tolist(), strict=True):
        h[a:b].sort()
    keep = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])) if len(h) else np.zeros(0, bool)
    h, row = h[keep], row[keep]
    return h, np.searchsorted(row, np.arange(len(n) + 1))


def set_keys(h: np.ndarray, first: np.ndarray):
    """Two 64-bit keys of each set, sums of two scramblings of its members."""
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(salt)), dtype=np.uint64)])
        out.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
    return out


def describe(batches, k: int, least_here: int = 3):
    """A row for each text: id, size and keys of its set; and rows for shingles that several texts of a slice have."""
    for batch in batches:
        for part in slices(batch):
            h, first = shingle_sets(part["text"], k)
            k1, k2 = set_keys(h, first)
            n = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, bool)), part["doc_id"], pa.array(np.diff(first)), pa.array(k1), pa.array(k2)],
                ["common", "doc_id", "n", "k1", "k2"])
            values, counts = np.unique(h, return_counts=True)
            values, counts = values[counts >= least_here], counts[counts >= least_here]
            if len(values):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(len(values), bool)), pa.nulls(len(values), pa.int64()), pa.array(counts),
                     pa.array(values.view(np.int64)), pa.nulls(len(values), pa.int64())], ["common", "doc_id", "n", "k1", "k2"])


def lead(n, percent: int):
    """Shingles that two linked sets, the smaller of size n, share at least at their fronts."""
    return F.least(F.lit(LEAD), F.ceil(F.lit(percent) * n / 100))


def frequency(h: np.ndarray, common: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The level of each shingle in the global order, 0 for all that are not frequent."""
    if not len(common):
        return np.zeros(len(h), dtype=np.uint8)
    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
    return np.where(common[at] == h, level[at], 0)


def prefixes(batches, k: int, percent: int, common: np.ndarray, level: np.ndarray):
    """The first shingles of each set in the global order: (token, place, size, keys)."""
    for batch in batches:
        for part in slices(batch, PART_BYTES):
            h, first = shingle_sets(part["text"], k)
            k1, k2 = set_keys(h, first)
            size = np.diff(first)
            row = np.repeat(np.arange(len(size)), size)
            # A set's shingles are sorted, so a stable sort by place in the order is enough.
            h = h[np.argsort(row * 256 + frequency(h, common, level), kind="stable")]
            place = np.arange(len(h)) - first[:-1][row]
            # Of the shared shingles at least ``LEAD`` lie in both fronts of this length.
            # Sets with fewer shingles than percent / (100 - percent) link with equal ones only.
            least = (percent * size + 99) // 100
            length = np.where((100 - percent) * size >= percent, size - least + np.minimum(LEAD, least), 0)
            keep = place < length[row]
            r = row[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[keep].view(np.int64)), pa.array(place[keep].astype(np.int32)), pa.array(size[r].astype(np.int32)),
                 pa.array(k1[r])], ["token", "place", "n", "k1"])


def shared(batches):
    """Of rows (token, place, n, k1) in the order of token and k1: one for each token and k1, where the token has several k1.

    A batch's last row waits for the next; what is held does not grow with a token's rows.
    """
    held, several = None, False  # the last row so far, and whether the one before it has its token
    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        token, k1 = rows["token"].to_numpy(), rows["k1"].to_numpy()
        at = np.flatnonzero(np.append(True, (token[1:] != token[:-1]) | (k1[1:] != k1[:-1])))
        same = token[at[1:]] == token[at[:-1]]
        before, behind = np.append(several, same), np.append(same, False)
        yield from rows.take(pa.array(at[:-1][(before | behind)[:-1]])).to_batches()
        held, several = rows.slice(at[-1], 1).to_batches()[0], bool(before[-1])
    if several:
        yield held


def whole_sets(batches, k: int):
    """Each text's keys, whole set and profile, packed."""
    for batch in batches:
        for part in slices(batch, PART_BYTES):
            h, first = shingle_sets(part["text"], k)
            k1, k2 = set_keys(h, first)
            sets = [h[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part["node"], part["k1"], part["k2"], pa.array(k1), pa.array(k2),
                                              pa.array(sets, pa.binary()),
                                              pa.array([profile(h[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                                             ["node", "want1", "want2", "k1", "k2", "members", "profile"])


def profile(members: np.ndarray) -> bytes:
    """The set's size and its members counted by the leading bits of their hash, one or two for a count."""
    bits = len(members).bit_length()
    counts = np.bincount((members >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(members), np.int64),
                         minlength=1 << bits)
    kind = next(t for t in ("<u1", "<u2", "<u4") if counts.max() <= np.iinfo(t).max)
    return np.array([len(members), 1 << bits], dtype="<u4").tobytes() + counts.astype(kind).tobytes()


def read_profile(buf) -> tuple[int, np.ndarray]:
    n, bins = np.frombuffer(buf, "<u4", 2).tolist()
    return n, np.frombuffer(buf, f"<u{(len(buf) - 8) // bins}", bins, 8).astype(np.int64)


def far_by_profile(batches, least: int):
    """(a, b, least distance that the profiles allow, whether it proves a similarity below least percent)."""
    for batch in batches:
        low, far = [], []
        for a, b in zip(batch["profile_a"], batch["profile_b"], strict=True):
            (n, x), (m, y) = read_profile(a.as_buffer()), read_profile(b.as_buffer())
            bins = min(len(x), len(y))
            both = int(np.minimum(x.reshape(bins, -1).sum(axis=1), y.reshape(bins, -1).sum(axis=1)).sum())
            low.append(1 - both / (n + m - both))
            far.append(100 * both < least * (n + m - both))
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(low, pa.float64()), pa.array(far, pa.bool_())],
                                         ["a", "b", "low", "far"])


def in_sorted(x: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which elements of x the sorted, non-empty values hold."""
    return values[np.minimum(np.searchsorted(values, x), len(values) - 1)] == x


def least_common(s: int, n: int, near: bool, percent: int) -> int:
    """Least common part of a set's difference (s shingles, the set n) with that of any set it can link with.

    A set y links with x when |x ^ y| <= c (|x| + |y|), c = (100 - P) / (100 + P). x ^ y is the symmetric
    difference of the two differences, so their common part is at least (s_x + s_y - c (n_x + n_y)) / 2.
    Where y is beyond the threshold of the pivot p, s_y > c (n_y + n_p); with n_x <= n_p + s_x the common
    part is more than s_x (1 - c) / 2 = s_x P / (100 + P). Only a set x that is itself beyond it can link with a
    y within; then s_y >= s_x - c (n_x + n_y), and the common part is at least s_x - n_x (100 - P) / P, and 1.
    """
    beyond = s * percent // (100 + percent) + 1
    return beyond if near else max(1, min(beyond, s - n * (100 - percent) // percent))


def differences(batches, percent: int, common: np.ndarray, level: np.ndarray):
    """Sets a against their pivots b: (a, b, near, far, distance, size of the difference, its first shingles).

    A far set has a similarity below ``FAR``, or is at more than twice the threshold distance where that is
    farther: it links with nothing near the pivot, and its difference says little, so it is not listed. Any order of a difference that depends on the shingle and the pivot alone is valid. Shingles that
    the pivot lacks come first, rare ones in front; of those only the pivot has, the rare ones, which
    most sets lack, come last.
    """
    for batch in batches:
        near, far, d, s, front = [], [], [], [], []
        for a, b in zip(batch["set_a"], batch["set_b"], strict=True):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            held = in_sorted(x, y)
            added, both = x[~held], int(held.sum())
            missing = y[~in_sorted(y, x)]
            union = len(x) + len(missing)
            near.append(100 * both >= percent * union)
            far.append(100 * both < min(FAR, 2 * percent - 100) * union)
            d.append(1 - both / union)
            s.append(len(added) + len(missing))
            if far[-1]:
                front.append(None)
                continue
            length = s[-1] - least_common(s[-1], len(x), near[-1], percent) + 1
            added = added[np.lexsort((added, frequency(added, common, level)))][:length]
            if len(added) < length:
                missing = missing[np.lexsort((missing, frequency(missing, common, level) == 0))][:length - len(added)]
                added = np.concatenate([added, missing])
            front.append(added.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch["a"], batch["b"], pa.array(near, pa.bool_()), pa.array(far, pa.bool_()), pa.array(d, pa.float64()),
             pa.array(s, pa.int32()), pa.array(front, pa.list_(pa.int64()))], ["a", "b", "near", "far", "d", "s", "front"])


def close(batches, percent: int):
    """Pairs a, b of packed, sorted sets that are within the threshold."""
    for batch in batches:
        near = []
        for a, b in zip(batch["set_a"], batch["set_b"], strict=True):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            both = int(in_sorted(x, y).sum())
            near.append(100 * both >= percent * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(near, pa.bool_()))


class Join:
    """One run of the join; keeps what its steps share."""

    def __init__(self, docs: DataFrame, k: int, percent: int):
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        self.k, self.percent = k, percent

    def classes(self) -> DataFrame:
        """(k1, k2, n, node, least_id): the distinct non-empty sets; node is the class's own key, as
        texts of different classes may share their least id."""
        k = self.k
        self.described = materialize(self.docs.mapInArrow(
            lambda it: released(describe(it, k)), "common boolean, doc_id long, n long, k1 long, k2 long"), "jaccard-sets")
        self.rows = self.described.where("not common").select("doc_id", "n", "k1", "k2")
        found = self.rows.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("least_id"))
        return materialize(found.withColumn("node", F.col("k1")), "jaccard-classes")

    def global_order(self):
        """Frequent shingles with the logarithm of their frequency; all others are rarer and come first.

        Bounded: a shingle needs one text in ``COMMON_SHARE``, so there are at
        most that many times the mean set size; the share is raised if that is
        still too many.
        """
        n_docs = self.rows.count()
        counts = self.described.where("common").groupBy("k1").agg(F.sum("n").alias("n"))
        least = max(20, n_docs // COMMON_SHARE)
        while (many := counts.where(F.col("n") >= least).count()) > MAX_COMMON:
            least *= 2
        if not many:
            return np.empty(0, np.uint64), np.empty(0, np.uint8)
        got = counts.where(F.col("n") >= least).select("k1", F.floor(F.log2("n")).cast("int").alias("level")).toPandas()
        common, level = got["k1"].to_numpy().view(np.uint64), got["level"].to_numpy().astype(np.uint8)
        order = np.argsort(common)
        return common[order], level[order]

    def regions(self, classes: DataFrame) -> DataFrame:
        """(region, node, n, s, place, later): the sets of each region, for regions with two or more; see ``links``."""
        k, percent = self.k, self.percent
        sc = self.docs.sparkSession.sparkContext
        self.order = order = sc.broadcast(self.global_order())
        row = "token long, place int, n int, k1 long"
        first = self.docs.select("text").mapInArrow(lambda it: released(prefixes(it, k, percent, *order.value)), row)
        # One pass over the texts and one exchange: sorted by token, neighbours tell which tokens several sets have.
        members = first.repartition("token").sortWithinPartitions("token", "k1").mapInArrow(lambda it: released(shared(it)), row)
        members = materialize(members.withColumnRenamed("k1", "node"), "jaccard-shared")
        # Copies have a hundred tokens in common: those that the same sets have are one from here on, counted in ``tokens``.
        same = members.groupBy("token").agg(F.bit_xor(F.xxhash64("node")).alias("same"))
        written = materialize(members.join(same, "token").groupBy("same", "node", "n").agg(
            F.min("place").alias("place"), F.count("*").alias("tokens")), "jaccard-shared")
        discard(members)
        # Sizes of linked sets lie in one band or in two that follow one another; a region has two bands.
        band = F.floor(F.log(F.col("n")) / F.lit(math.log(100 / percent) * (1 + 1e-6)))
        members = written.withColumn("band", F.explode(F.array(band, band - 1)))
        members = members.select(F.xxhash64("same", "band").alias("region"), "band", "node", "n", "place", "tokens")
        members = members.join(self.several(members, "node"), "region")
        # A link needs several shingles in common here; a set with fewer in all regions of a band has none.
        # Its partner may be smaller, by the threshold at most.
        enough = members.groupBy("node", "band").agg(F.sum("tokens").alias("shared"), F.max("n").alias("n")).where(
            F.col("shared") >= lead(F.col("n") * percent / 100, percent)).select("node", "band")
        members = materialize(members.join(enough, ["node", "band"]).select("region", "node", "n", "place"), "jaccard-enough")
        discard(written)
        out = self.merged(members.select("region", "node", "n", F.col("n").alias("s"), "place", F.lit(False).alias("later"),
                                         F.col("node").alias("cell")))
        discard(members)
        return out

    @staticmethod
    def several(members: DataFrame, what: str) -> DataFrame:
        """Regions with two or more different values."""
        return members.groupBy("region").agg(F.min(what).alias("lo"), F.max(what).alias("hi")).where("lo <> hi").select("region")

    def sets(self, regions: DataFrame, classes: DataFrame) -> DataFrame:
        """(node, members, profile): the whole sets of the classes that are in a region, and their profiles."""
        k = self.k
        wanted = materialize(classes.join(regions.select("node").distinct(), "node").select("least_id", "k1", "k2", "node"), "jaccard-wanted")
        # Few ids go to the texts; beyond the bound texts and ids meet in a shuffle.
        ids = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
        texts = self.docs.join(ids, F.col("doc_id").eqNullSafe(F.col("least_id"))).select("text", "node", "k1", "k2")
        found = texts.mapInArrow(lambda it: released(whole_sets(it, k)), "node long, want1 long, want2 long, k1 long, k2 long, members binary, profile binary")
        # An id may stand for several texts; the keys tell the one that is meant.
        with arrow_rows(self.docs.sparkSession, SET_ROWS):
            out = materialize(found.where("k1 = want1 and k2 = want2").select("node", "members", "profile"), "jaccard-members")
        if out.select("node").groupBy("node").count().where("count > 1").isEmpty():
            return out
        return materialize(out.dropDuplicates(["node"]), "jaccard-members")

    def possible(self, regions: DataFrame, cells: DataFrame) -> DataFrame:
        """The regions with sets of different cells, without the sets whose difference has too little behind the
        shared place for a link with any set of the region. A set that links with nothing is its own cell."""
        p = self.percent
        known = regions.join(cells, "node", "left").withColumn("cell", F.coalesce("cell", "node"))
        bounds = known.groupBy("region").agg(F.min("cell").alias("lo"), F.max("cell").alias("hi"), F.min("s").alias("s_least"),
                                             F.max("n").alias("n_most")).where("lo <> hi")
        s, n, place = F.col("s"), F.col("n"), F.col("place")
        room = (100 + p) * (s + F.col("s_least") - 2 * (s - place)) <= (100 - p) * (n + F.col("n_most"))
        return known.join(bounds, "region").where(room).select("region", "node", "n", "s", "place", "later", "cell")

    @staticmethod
    def merged(regions: DataFrame) -> DataFrame:
        """The regions with sets of different cells, those with the same sets and differences as one: (region, node, n, s,
        place, later, cell, many, weight).

        A link is looked for behind the first shared place, so a set keeps its least place. ``many`` is the
        number of the region's sets, ``weight`` that of all regions that the set is in.
        """
        alike = regions.groupBy("region").agg(F.min("cell").alias("lo"), F.max("cell").alias("hi"), F.count("*").alias("many"),
                                              F.bit_xor(F.xxhash64("node", "s")).alias("same")).where("lo <> hi")
        out = regions.join(alike, "region").groupBy("same", "node", "s").agg(
            F.min("place").alias("place"), F.max("n").alias("n"), F.min("later").alias("later"), F.max("cell").alias("cell"),
            F.max("many").alias("many"), F.count("*").alias("tokens"))
        out = materialize(out, "jaccard-merged")
        weight = out.groupBy("node").agg(F.sum("tokens").alias("weight"))
        done = materialize(out.join(weight, "node").select(F.col("same").alias("region"), "node", "n", "s", "place", "later", "cell",
                                                           "many", "weight"), "jaccard-regions")
        discard(out)
        return done

    def with_sets(self, pairs: DataFrame, sets: DataFrame, column: str = "members", name: str = "set") -> DataFrame:
        """Distinct, written pairs of nodes with both whole sets, or both profiles.

        Few pairs, and ids of few sets, go to the sets; so only sets that are compared are shuffled, not all
        of them for each step. Beyond the bound pairs and sets meet in a shuffle.
        """
        few = F.broadcast if pairs.count() <= BROADCAST_ROWS else lambda df: df
        a, b = (sets.select(F.col("node").alias(x), F.col(column).alias(f"{name}_{x}")) for x in "ab")
        b = b.join(few(pairs.select("b").distinct()), "b", "left_semi")
        return a.join(few(pairs), "a").join(b, "b").select("a", "b", f"{name}_a", f"{name}_b")

    def compared(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Each distinct (a, pivot b) with its difference, see ``differences``; whole sets are sent only
        where the profiles do not prove that they are far, else the distance is a lower bound."""
        percent, order = self.percent, self.order
        with arrow_rows(self.docs.sparkSession, SET_ROWS):
            judged = self.judged(pairs, sets, min(FAR, 2 * percent - 100))
            far = judged.where("far").selectExpr("a", "b", "false as near", "far", "low as d", "cast(null as int) as s",
                                                 "cast(null as array<long>) as front")
            out = materialize(far.union(self.with_sets(judged.where("not far").select("a", "b"), sets).mapInArrow(
                lambda it: released(differences(it, percent, *order.value)),
                "a long, b long, near boolean, far boolean, d double, s int, front array<long>")), "jaccard-compared")
        discard(judged)
        return out

    def judged(self, pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
        """Each distinct (a, b) with what the profiles tell, see ``far_by_profile``."""
        with arrow_rows(self.docs.sparkSession, SET_ROWS):
            return materialize(self.with_sets(pairs, sets, "profile", "profile").mapInArrow(
                lambda it: released(far_by_profile(it, least)), "a long, b long, low double, far boolean"), "jaccard-judged")

    def mixed(self, star: DataFrame, cells: DataFrame) -> DataFrame:
        """The star's rows of regions with sets of different cells; a set that links with nothing is its own cell."""
        known = star.join(cells.withColumnRenamed("node", "a"), "a", "left").withColumn("cell", F.coalesce("cell", "a"))
        return known.join(self.several(known, "cell"), "region").drop("cell")

    def links(self, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
        """(classes, links between their nodes): enough links to join what is joined.

        In a region, ``s`` is the size of each set's difference and ``place`` that of the region's shingle
        in it; at first these are the whole set's, its difference with an empty one. Sets ``later`` are no
        pivots while there are others.
        """
        classes = self.classes()
        regions = self.regions(classes)
        sets = self.sets(regions, classes)
        edges = self.docs.sparkSession.createDataFrame([], "a long, b long")
        epsilon = 1 - self.percent / 100 + 1e-9
        at_once = classes.count()
        for _ in range(levels):
            if regions.isEmpty():
                return classes, edges
            # A region of few sets is compared at once; a level more costs more than its pairs.
            pairs = regions.where(F.col("many") > FEW).agg(F.sum((F.col("many") - 1) / 2)).first()[0]
            if (pairs or 0) <= at_once:
                break
            edges = edges.union(self.rest(regions.where(F.col("many") <= FEW), sets))
            before, regions = regions, materialize(regions.where(F.col("many") > FEW), "jaccard-large")
            discard(before)
            # The set that is in most regions is the middle of its copies, and the pivot of all regions that it is in.
            pivots = regions.groupBy("region").agg(F.min(F.struct("later", -F.col("weight"), "node")).alias("p")).select("region", F.col("p.node").alias("b"))
            star = regions.join(pivots, "region").where(F.col("node") != F.col("b"))
            star = materialize(star.select("region", F.col("node").alias("a"), "b", "n", F.col("s").alias("s_here"), "place"), "jaccard-star")
            discard(regions)
            measured = self.compared(materialize(star.select("a", "b").distinct(), "jaccard-pairs"), sets)
            edges = materialize(edges.union(measured.where("near").select("a", "b")), "jaccard-edges")
            cells = materialize(connected_components(edges.toDF("src", "dst")).toDF("node", "cell"), "jaccard-cells")
            # Where all sets are joined now nothing is left to find.
            on = materialize(self.mixed(star, cells).join(measured.drop("front"), ["a", "b"]), "jaccard-on")
            discard(star)
            # Pairs of sets that are not far meet where their differences do.
            front = measured.join(on.where("not far").select("a", "b", "n").distinct(), ["a", "b"])
            front = front.select(F.col("a").alias("node"), "b", "n", "s", F.posexplode("front").alias("place", "shingle"))
            deeper = front.select(F.xxhash64("b", "shingle").alias("region"), "node", "n", "s", "place", F.lit(False).alias("later"))
            # Far sets go on with the next pivot, and with them the boundary sets that their window reaches.
            window = on.where("far").groupBy("region").agg((F.min("d") - epsilon).alias("from"))
            again = on.join(window, "region").where("far or (not near and d >= from)")
            again = again.select("region", F.col("a").alias("node"), "n", F.col("s_here").alias("s"), "place", (~F.col("far")).alias("later"))
            deeper = materialize(self.possible(deeper.union(again), cells), "jaccard-deeper")
            discard(measured, on)
            regions = self.merged(deeper)
            discard(deeper)
        return classes, edges.union(self.rest(regions, sets))

    def rest(self, regions: DataFrame, sets: DataFrame) -> DataFrame:
        """Links among the sets of a region that are in different cells."""
        p = self.percent
        x, y = regions.alias("x"), regions.alias("y")
        nx, ny, sx, sy = (F.col(c) for c in ("x.n", "y.n", "x.s", "y.s"))
        # Of the common part that a link needs, enough must follow the shared place in both differences.
        room = F.least(sx - F.col("x.place"), sy - F.col("y.place"))
        pairs = x.join(y, "region").where(
            (F.col("x.cell") != F.col("y.cell")) & (F.col("x.node") < F.col("y.node"))
            & (100 * F.least(nx, ny) >= p * F.greatest(nx, ny))
            & ((100 + p) * (sx + sy - 2 * room) <= (100 - p) * (nx + ny)))
        pairs = materialize(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "jaccard-rest")
        # Whole sets are sent only where the profiles leave a link possible.
        judged = self.judged(pairs, sets, p)
        with arrow_rows(self.docs.sparkSession, SET_ROWS):
            out = materialize(self.with_sets(judged.where("not far").select("a", "b"), sets).mapInArrow(
                lambda it: released(close(it, p)), "a long, b long"), "jaccard-close")
        discard(judged, pairs)
        return out


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90, levels: int = LEVELS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Rows link when their sets of k-word shingles have a Jaccard similarity of
    percent / 100 or more; component_id is the smallest id reachable. Null,
    empty and blank texts have the empty set and link with nothing. One row
    out per row in; rows with equal sets, repeated ids included, are linked.
    A null id takes part but is no component's id unless all are null.
    """
    join = Join(docs, k, percent)
    with setting(docs.sparkSession, SHUFFLE_CLEANUP, True):
        classes, edges = join.links(levels)
        comps = materialize(connected_components(edges.toDF("src", "dst")), "jaccard-components")
    named = comps.join(classes.select("node", "least_id"), "node").groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_class = (classes.join(comps.join(named, "component").select("node", "component_id"), "node", "left")
                .select("k1", "k2", F.coalesce("component_id", "least_id").alias("component_id")))
    full = join.rows.where("n > 0").join(by_class, ["k1", "k2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = join.rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
