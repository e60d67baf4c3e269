"""Hard negatives by best-first descent of cover trees.

Vectors become whole numbers, floor(SCALE * x), and a row's score is its integer inner product with the anchor. One more
coordinate, sqrt(M^2 - |x|^2) with M the largest norm, puts all candidates on one sphere, where an anchor has a zero:
inner products stay, and order candidates as angles do.

A cover tree halves its covering angle from level to level: the centres of a node's children are farther from each other
than that and cover its rows. A node has WIDTH children at most; where more centres were needed, as in many dimensions
without clusters, the rows left go to the nearest centre, and the covering angle, which is measured, is wider. Of a node
whose centre stands at angle t from the anchor and whose rows lie within angle r of the centre, every score is between
|q| M cos(t + r) and |q| M cos(t - r). A descent opens the node with the highest upper bound first, capped by the window's
end, skips nodes outside the window, and ends when no node left can hold a row that ranks among those found. Bounds are
widened by more than their rounding; rows of opened leaves are scored in whole numbers, once per anchor.

Candidates are dealt to blocks of about BLOCK rows by a hash of id and vector, whatever their label, and each block's tree
is built in one task and written once. Anchors are packed in blocks of at most ANCHORS. Every anchor block meets every
tree: first for the anchor's positives, then for the windows they give. What a tree finds is at most as many rows as are
asked for, and these are merged by rank.

Rows with a null label, a null vector, or a null or non-finite component take no part, nor do rows without an id. Rows
that repeat an id, label and vector count once; rows that share an id only are never each other's positive or negative.
Shorter vectors are filled with zeros. Scores beyond 64 bits are an error. Ties go to the smaller id. An empty table, or
one without anchors, gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickbars.llm.shared import written

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
BLOCK = 4096
ANCHORS = 1024
LEAF = 512
WIDTH = 16
#: Tasks that block pairs are dealt to, where there are as many pairs.
TASKS = 4096
#: Wider than the rounding of an angle or a bound in doubles.
SLACK = 1e-6
_LEAST, _MOST = -(2**63), 2**63 - 1

TREE = "block int, points binary, labels binary, ids binary, vectors binary, nodes binary, angles binary"


@dataclass
class Tree:
    """Rows in leaf order, and nodes in breadth-first order: centre (a row), first and last child, first and last row."""

    points: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray
    nodes: np.ndarray
    angles: np.ndarray

    @classmethod
    def build(cls, points, labels, ids, vectors, norm: float, leaf: int = LEAF) -> Tree:
        plain = vectors.astype(np.float64)
        squares = np.einsum("ij,ij->i", plain, plain)
        unit = np.column_stack([plain, np.sqrt(np.maximum(norm * norm - squares, 0))]) / (norm or 1.0)
        nodes, angles, order = [], [], []
        queue, done = [(0, np.arange(len(ids)))] if len(ids) else [], 0
        while done < len(queue):
            centre, members = queue[done]
            done += 1
            rows = unit[members]
            angle = float(_angles(rows @ unit[centre]).max())
            angles.append(angle)
            if len(members) <= leaf or angle <= SLACK:
                nodes.append((centre, 0, 0, len(order), len(order) + len(members)))
                # By id, so that a stable sort by score leaves ties in their order.
                order.extend(members[np.lexsort((points[members], ids[members]))].tolist())
                continue
            children = list(_net(members, rows, unit, centre, angle / 2))
            nodes.append((centre, len(queue), len(queue) + len(children), 0, 0))
            queue.extend(children)
        order = np.array(order, np.int64)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        nodes = np.array(nodes, np.int64).reshape(-1, 5)
        nodes[:, 0] = place[nodes[:, 0]] if len(order) else nodes[:, 0]
        return cls(points[order], labels[order], ids[order], vectors[order], nodes, np.array(angles))

    def search(self, anchors: Anchors, norm: float, k: int, same_label: bool) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """For each window: its number, and places and scores of the first ``k`` rows of this tree, best first."""
        found = []
        plain = self.vectors.astype(np.float64)
        centres, wide = plain[self.nodes[:, 0]], self.angles + SLACK
        most = int(np.abs(self.vectors).max(initial=0))
        nodes = self.nodes.tolist()
        for i in range(len(anchors.ids)):
            q = anchors.vectors[i].astype(np.float64)
            reach = float(np.sqrt(q @ q)) * norm
            centre = np.arccos(np.clip(centres @ q / (reach or 1.0), -1, 1))
            slack = reach * SLACK + 1
            upper = reach * np.cos(np.maximum(centre - wide, 0)) + slack
            lower = reach * np.cos(np.minimum(centre + wide, np.pi)) - slack
            # Doubles are exact as far as they can count.
            exact = plain if most * int(np.abs(anchors.vectors[i]).max(initial=0)) * len(q) < 2**53 else None
            leaves: dict[int, tuple[np.ndarray, np.ndarray]] = {}

            def leaf(row: int, last: int, i=i, q=q, exact=exact):
                """The rows that may be a positive, or a negative, best first: negated scores and places."""
                fit = (self.labels[row:last] == anchors.labels[i]) == same_label
                fit &= self.ids[row:last] != anchors.ids[i]
                if exact is None:
                    scores = products(self.vectors[row:last][fit], anchors.vectors[i])
                else:
                    scores = (exact[row:last] @ q)[fit].astype(np.int64)
                # Negated as ~x, which cannot overflow.
                scores = ~scores
                order = np.argsort(scores, kind="stable")
                return scores[order], (np.flatnonzero(fit) + row)[order]

            for window in range(anchors.first[i], anchors.first[i + 1]):
                low, high = int(anchors.low[window]), int(anchors.high[window])
                places, negated = self._descend(nodes, upper, lower, low, high, k, leaf, leaves)
                if len(places):
                    found.append((window, places, ~negated))
        return found

    def _descend(self, nodes, upper, lower, low, high, k, leaf, leaves):
        """Best first from the root; ``negated`` holds the best rows' scores, the last of them is the one to beat."""
        places, negated = np.zeros(0, np.int64), np.zeros(0, np.int64)
        top = float(high)
        heap = [(-min(upper[0], top), 0)] if nodes and upper[0] >= low and lower[0] <= high else []
        while heap:
            bound, node = heapq.heappop(heap)
            if len(places) == k and -bound < ~negated[-1]:
                break
            _, child, last_child, row, last_row = nodes[node]
            if last_child > child:
                inside = np.flatnonzero((upper[child:last_child] >= low) & (lower[child:last_child] <= high)) + child
                for at in inside.tolist():
                    key = min(upper[at], top)
                    if len(places) < k or key >= ~negated[-1]:
                        heapq.heappush(heap, (-key, at))
                continue
            if node not in leaves:
                leaves[node] = leaf(row, last_row)
            scores, rows = leaves[node]
            first = scores.searchsorted(~high)
            last = min(scores.searchsorted(~low, side="right"), first + k)
            if last <= first or len(places) == k and scores[first] > negated[-1]:
                continue
            places, negated = np.concatenate((places, rows[first:last])), np.concatenate((negated, scores[first:last]))
            order = np.lexsort((self.points[places], self.ids[places], negated))[:k]
            places, negated = places[order], negated[order]
        return places, negated


@dataclass
class Anchors:
    """A block of anchors; anchor i has the windows ``first[i]`` to ``first[i + 1]``."""

    points: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray
    first: np.ndarray
    keys: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


def _net(members, rows, unit, centre, radius):
    """Members within ``radius`` of centres that are farther than that from each other; the first is the node's own. Rows
    that WIDTH centres leave over go to the nearest."""
    centres, parts, left = [], [], np.arange(len(members))
    while len(left) and len(centres) < WIDTH:
        near = _angles(rows[left] @ unit[centre]) <= radius
        # The centre itself, whose angle may be rounded.
        near |= members[left] == centre
        centres.append(centre)
        parts.append([left[near]])
        left = left[~near]
        if len(left):
            centre = members[left[0]]
    if len(left):
        nearest = (rows[left] @ unit[centres].T).argmax(axis=1)
        for i, part in enumerate(parts):
            part.append(left[nearest == i])
    for centre, part in zip(centres, parts, strict=True):
        yield centre, members[np.concatenate(part)]


def products(vectors: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number vectors as 64-bit integers."""
    if not len(vectors):
        return np.zeros(0, np.int64)
    most = int(np.abs(vectors).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(len(q), 1)
    if most < 2**53:
        return (vectors.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    if most < 2**63:
        return vectors @ q
    raise OverflowError("a score may pass 64 bits")


def quantised(vectors: pd.Series, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, filled with zeros up to ``width``."""
    out = np.zeros((len(vectors), width), np.float64)
    for i, vector in enumerate(vectors):
        out[i, : len(vector)] = vector
    out = np.floor(scale * out)
    if len(out) and np.abs(out).max(initial=0) >= 2**62:
        raise OverflowError("a component passes 62 bits")
    return out.astype(np.int64)


def usable(vectors: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """Rows (id, label, vector) that take part, each combination once."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    return rows.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector")).distinct()


def _merged(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each key over all trees, with their rank; a key has at most k rows of each tree."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "other_id", "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _trees(points: DataFrame, rows: int, width: int, norm: float, block: int, scale: int, leaf: int) -> DataFrame:
    def built(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("point")
        whole = quantised(rows["vector"], width, scale)
        tree = Tree.build(rows["point"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), rows["id"].to_numpy(np.int64), whole, norm, leaf)
        packed = [x.tobytes() for x in (tree.points, tree.labels, tree.ids, tree.vectors, tree.nodes, tree.angles)]
        return pd.DataFrame([[int(rows["block"].iloc[0]), *packed]], columns=[part.split()[0] for part in TREE.split(", ")])

    blocks = -(-rows // block)
    dealt = points.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int"))
    return written(dealt.groupBy("block").applyInPandas(built, TREE), "trees")


def _searched(trees: DataFrame, anchors: DataFrame, blocks: int, width: int, norm: float, k: int, same_label: bool, scale: int) -> DataFrame:
    """What each tree has for the windows (anchor, key, low, high) of anchors (point, id, label, vector, windows)."""
    anchors = anchors.withColumn("part", F.pmod(F.xxhash64("point"), F.lit(blocks)).cast("int"))
    packs = anchors.groupBy("part").agg(F.collect_list(F.struct("point", "id", "label", "vector", "windows")).alias("anchors"))
    # Each anchor block with each tree: two numbered lists of blocks, dealt by the number of the anchor block.
    both = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(packs, "part")
    both = both.repartition(min(TASKS, blocks * trees.count()), "block", "part")

    def rows(batches):
        for batch in batches:
            yield _found(batch, width, norm, k, same_label, scale)

    return both.mapInPandas(rows, "anchor long, key long, other long, other_id long, score long")


def _found(batch: pd.DataFrame, width: int, norm: float, k: int, same_label: bool, scale: int) -> pd.DataFrame:
    made = [np.zeros((0, 5), np.int64)]
    for row in batch.itertuples():
        tree = Tree(*[np.frombuffer(x, np.int64) for x in (row.points, row.labels, row.ids)],
                    np.frombuffer(row.vectors, np.int64).reshape(-1, width), np.frombuffer(row.nodes, np.int64).reshape(-1, 5), np.frombuffer(row.angles, np.float64))
        packed = list(row.anchors)
        windows = [list(a["windows"]) for a in packed]
        flat = np.array([[w["key"], w["low"], w["high"]] for some in windows for w in some], np.int64).reshape(-1, 3)
        sizes = np.concatenate(([0], np.cumsum([len(some) for some in windows])))
        numbers = np.array([[a["point"], a["label"], a["id"]] for a in packed], np.int64).reshape(-1, 3)
        anchors = Anchors(*numbers.T, quantised(pd.Series([a["vector"] for a in packed]), width, scale), sizes, *flat.T)
        of_window = np.repeat(anchors.points, np.diff(sizes))
        for window, places, best in tree.search(anchors, norm, k, same_label):
            n = len(places)
            made.append(np.column_stack([np.full(n, of_window[window]), np.full(n, anchors.keys[window]), tree.points[places], tree.ids[places], best]))
    return pd.DataFrame(np.concatenate(made), columns=["anchor", "key", "other", "other_id", "score"])


def mine(
    vectors: DataFrame,
    anchors: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    *,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    block: int = BLOCK,
    leaf: int = LEAF,
) -> DataFrame:
    """Rows anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on ``id``. An anchor's positives are its ``positives`` best rows of the same label; for each
    of them the ``negatives`` best rows of other labels with low * p <= 100 * score <= high * p are returned, p being the
    positive's score.
    """
    rows = usable(vectors, id, vector, label).withColumn("anchor", anchors)
    points = written(rows.withColumn("point", F.monotonically_increasing_id()), "points")
    whole = F.transform("vector", lambda x: F.floor(x * scale).cast("double"))
    norm = F.sqrt(F.aggregate(whole, F.lit(0.0), lambda acc, x: acc + x * x))
    facts = points.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.size("vector")).alias("width"), F.max(norm).alias("norm")).first()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not facts["anchors"]:
        return vectors.sparkSession.createDataFrame([], result)
    width, norm, parts = max(facts["width"], 1), facts["norm"] * (1 + 1e-12), -(-facts["anchors"] // ANCHORS)
    trees = _trees(points.drop("anchor"), facts["n"], width, norm, block, scale, leaf)
    chosen = points.where("anchor").drop("anchor")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("key"), F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high")))
    near = _searched(trees, chosen.withColumn("windows", everything), parts, width, norm, positives, True, scale)
    near = written(_merged(near, ["anchor"], positives), "positives")

    exact = F.col("score").cast("decimal(22,0)")
    bounds = near.withColumns({"from": F.ceil(exact * low / 100).cast("long"), "to": F.floor(exact * high / 100).cast("long")})
    # At most ``positives`` windows an anchor.
    windows = bounds.where(F.col("from") <= F.col("to")).groupBy(F.col("anchor").alias("point")).agg(
        F.collect_list(F.struct(F.col("other").alias("key"), F.col("from").alias("low"), F.col("to").alias("high"))).alias("windows")
    )
    far = _searched(trees, chosen.join(windows, "point"), parts, width, norm, negatives, False, scale)
    far = _merged(far, ["anchor", "key"], negatives)
    pairs = near.select("anchor", F.col("other").alias("key"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = chosen.select(F.col("point").alias("anchor"), F.col("id").alias("anchor_id"))
    return far.join(pairs, ["anchor", "key"]).join(named, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
