"""Vector code compression: one small codebook per part, trained with anchors-hierarchy metric trees (operator 12).

A vector's components become integers, the vector is cut into equal parts, and every part position has a
codebook of a few entries. Rounds of assignment and integer means train the codebooks.

1. Vectors are packed into blocks of bounded size where they are read; nothing is shuffled. For every part of a
   block a metric tree is built middle-out: anchors (far points that take over the points nearest to them) make
   balls of about the square root of the block; the balls are merged upwards, smallest union first, and cut
   further by anchors of their own below. Every ball caches its points' sum and number. Blocks with their trees
   are a table in the shared folder, so a lost executor only rereads blocks.
2. A round sends the codebooks (a few hundred integers) to the blocks. Balls inherit their parent's list of
   entries and strike out the entries that can be nearest to none of their points; a ball with one entry left
   is owned by it and adds its cached sum and count without a look at its points. What remains at the leaves is
   compared point by point, exactly. Tasks return one row per part, entry and component.
3. The last pass assigns every part once more and adds up the errors.

Rows without a vector, or with null or non-finite components, are dropped; so are vectors whose length isn't
that of the vector with the smallest vec_id. Lengths that the parts don't divide are filled up with zeros. With
fewer vectors than entries, codebooks are as long as there are vectors. Equal vec_ids are ordered by components
and each row has its own result; a null vec_id comes last and never starts a codebook while others can. Results
are exact integers of any size; an error beyond a 64-bit integer is null. An empty table gives an empty result.
Other columns are ignored. One vector is held in memory whole, never a group of equal labels or vectors.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import map_batches, settle, table
from tapeworks.operators.chunks import bounded

# Fixed values of the query: scale, parts, entries, rounds.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
BLOCK_VALUES = 1 << 18  # components of a block
LEAF = 24  # points of a ball that isn't cut any further
FAR = 10**150  # bounds take greater components for this one
EXACT = 1 << 24  # greater components are counted in Python's integers
SALTS = 32


def floors(values: list[float], scale: int) -> np.ndarray | None:
    """floor(scale * x) per component, or None where one is null or not finite."""
    if None in values:
        return None
    scaled = np.array(values, np.float64)
    if not np.isfinite(scaled).all():
        return None
    if not len(scaled) or np.abs(scaled).max() * scale < EXACT:
        return np.floor(scaled * scale).astype(np.int64)
    return np.array([(n * scale) // d for n, d in (float(x).as_integer_ratio() for x in scaled)], object)


# ---- metric trees


def _squares(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    apart = points - center
    return np.einsum("ij,ij->i", apart, apart)


def _anchors(points: np.ndarray, many: int) -> np.ndarray:
    """The anchor of every point: each new one is the point farthest from its own, and takes what is nearer to it."""
    owner = np.zeros(len(points), np.int64)
    first = points[0]
    away = _squares(points, first)
    centers = [first]
    while len(centers) < many:
        far = int(away.argmax())
        if away[far] <= 0:
            break
        new = points[far]
        # a point can only change hands if it is farther from its anchor than half the way to the new one
        apart = np.array([np.dot(new - c, new - c) for c in centers])
        asked = np.flatnonzero(4 * away > apart[owner])
        there = _squares(points[asked], new)
        taken = there < away[asked]
        owner[asked[taken]], away[asked[taken]] = len(centers), there[taken]
        centers.append(new)
    return owner


class Tree:
    """Balls of one part's points: center, radius, sum, number, and their span in ``order``."""

    def __init__(self, points: np.ndarray):
        self.balls: list[tuple] = []  # (center, radius, sum, low, high, left, right)
        self.order: list[int] = []
        if points.dtype == object:  # too great for bounds in floating point: one ball without bounds
            self.order = list(range(len(points)))
            self.balls.append((np.zeros(points.shape[1]), np.inf, points.sum(axis=0), 0, len(points), -1, -1))
        else:
            self._build(points, points.astype(np.float64), np.arange(len(points)))
        center, radius, total, low, high, left, right = zip(*self.balls)
        self.center, self.radius = np.array(center), np.array(radius)
        self.total = np.array(total)
        self.low, self.high, self.left, self.right = (np.array(x, np.int64) for x in (low, high, left, right))
        self.order = np.array(self.order, np.int64)
        del self.balls

    def _add(self, points, real, rows, low, left=-1, right=-1) -> int:
        center = real[rows].mean(axis=0)
        radius = float(np.sqrt(_squares(real[rows], center).max()))
        self.balls.append((center, radius, points[rows].sum(axis=0), low, low + len(rows), left, right))
        return len(self.balls) - 1

    def _build(self, points, real, rows) -> int:
        low = len(self.order)
        if len(rows) > LEAF:
            owner = _anchors(real[rows], max(2, int(np.sqrt(len(rows)))))
            members = [rows[owner == k] for k in range(int(owner.max()) + 1)]
            members = [m for m in members if len(m)]
            if len(members) > 1:
                return self._merge(points, real, members)
        self.order.extend(rows.tolist())
        return self._add(points, real, rows, low)

    def _merge(self, points, real, members) -> int:
        """Join the two balls with the smallest common ball, until one is left; then write them out depth first."""
        centers = np.array([real[m].mean(axis=0) for m in members])
        radii = np.array([np.sqrt(_squares(real[m], c).max()) for m, c in zip(members, centers)])
        sizes = np.array([len(m) for m in members], float)
        shape: list = list(range(len(members)))
        apart = np.sqrt(((centers[:, None] - centers[None, :]) ** 2).sum(axis=2))
        reach = apart + radii[:, None] + radii[None, :]
        np.fill_diagonal(reach, np.inf)
        for _ in range(len(members) - 1):
            a, b = divmod(int(reach.argmin()), len(reach))
            center = (centers[a] * sizes[a] + centers[b] * sizes[b]) / (sizes[a] + sizes[b])
            radii[a] = max(np.linalg.norm(centers[a] - center) + radii[a], np.linalg.norm(centers[b] - center) + radii[b])
            centers[a], sizes[a], shape[a] = center, sizes[a] + sizes[b], (shape[a], shape[b])
            reach[b, :] = reach[:, b] = np.inf
            gone = np.isinf(reach[a])
            reach[a, :] = np.where(gone, np.inf, np.sqrt(((centers - center) ** 2).sum(axis=1)) + radii + radii[a])
            reach[a, a] = np.inf
            reach[:, a] = reach[a, :]
        top = shape[a]
        done: list[int] = []
        todo = [(top, False)]
        while todo:  # the halves first, then the ball over them; no recursion, as merges may be lopsided
            node, ready = todo.pop()
            if isinstance(node, int):
                done.append(self._build(points, real, members[node]))
            elif ready:
                right, left = done.pop(), done.pop()
                low = self.balls[left][3]
                done.append(self._add(points, real, np.array(self.order[low:]), low, left, right))
            else:
                todo += [(node, True), (node[1], False), (node[0], False)]
        return done[0]

    def settle_entries(self, entries: np.ndarray, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(balls, entry) wholly owned, level by level; then (rows, entry) of the points left over, negative balls."""
        real = np.clip(entries, -FAR, FAR).astype(np.float64)
        apart = ((real[:, None] - real[None, :]) ** 2).sum(axis=2)
        ball = np.array([len(self.left) - 1])
        listed = np.ones((1, len(real)), bool)
        left_over: list[np.ndarray] = []
        lists: list[np.ndarray] = []
        while len(ball):
            away = (self.center[ball] ** 2).sum(axis=1)[:, None] - 2 * self.center[ball] @ real.T + (real ** 2).sum(axis=1)[None, :]
            best = np.where(listed, away, np.inf).argmin(axis=1)
            here = away[np.arange(len(ball)), best]
            # an entry is nearer to no point if the ball lies on the best one's side of the plane between them
            between = np.sqrt(apart[best])
            slack = 1e-6 * (1 + np.abs(away) + np.abs(here[:, None]) + between * self.radius[ball][:, None])
            struck = (away - here[:, None] > 2 * self.radius[ball][:, None] * between + slack) & (apart[best] > 0)
            listed = listed & ~struck
            owned = listed.sum(axis=1) == 1
            yield ball[owned], best[owned]
            leaf = ~owned & (self.left[ball] < 0)
            left_over += list(ball[leaf])
            lists += list(listed[leaf])
            inner = ~owned & ~leaf
            ball = np.concatenate([self.left[ball[inner]], self.right[ball[inner]]])
            listed = np.concatenate([listed[inner], listed[inner]])
        if left_over:
            sizes = self.high[left_over] - self.low[left_over]
            rows = np.concatenate([self.order[self.low[b]:self.high[b]] for b in left_over])
            yield ~rows, nearest(points[rows], entries, np.repeat(np.array(lists), sizes, axis=0))


def nearest(points: np.ndarray, entries: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """The nearest listed entry of each point, exactly; ties to the lower index."""
    best = np.full(len(points), -1, np.int64)
    least = np.zeros(len(points), object if object in (points.dtype, entries.dtype) else np.int64)
    for k in range(len(entries)):
        at = np.flatnonzero(listed[:, k])
        away = squared(points[at], entries[k])
        better = (best[at] < 0) | (away < least[at])
        best[at[better]], least[at[better]] = k, away[better]
    return best


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    apart = points - entries
    return (apart * apart).sum(axis=1)


# ---- blocks


def _pack(batches: Iterator[dict], length: int, parts: int, scale: int) -> Iterator[dict]:
    size = max(1, BLOCK_VALUES // max(1, length))
    held: list[tuple] = []
    for batch in batches:
        for number, values, label in zip(batch["_id"].to_pylist(), batch["_vector"].to_pylist(), batch["_label"].to_pylist()):
            own = floors(values, scale) if values is not None and len(values) == length else None
            if own is not None:
                held.append((number, own, label))
                if len(held) >= size:
                    yield _block(held, parts)
                    held = []
    if held:
        yield _block(held, parts)


def _block(held: list[tuple], parts: int) -> dict:
    matrix = np.array([v for _, v, _ in held])
    matrix = np.pad(matrix, ((0, 0), (0, -matrix.shape[1] % parts)))
    cut = [np.ascontiguousarray(x) for x in np.split(matrix, parts, axis=1)]
    trees = [Tree(x) for x in cut]
    small = [x.astype(np.int32) if x.dtype != object else x for x in cut]
    return {
        "_ids": [[i for i, *_ in held]], "_labels": [[x for *_, x in held]],
        "_points": [pickle.dumps(small)], "_trees": [pickle.dumps([vars(t) for t in trees])],
    }


def _trees_of(raw: bytes) -> list[Tree]:
    out = []
    for balls in pickle.loads(raw):
        out.append(Tree.__new__(Tree))
        vars(out[-1]).update(balls)
    return out


def _points_of(raw: bytes) -> list[np.ndarray]:
    return [x if x.dtype == object else x.astype(np.int64) for x in pickle.loads(raw)]


def _one_round(batches: Iterator[dict], codebooks: list[list[list[int]]]) -> Iterator[dict]:
    books = [_integers(b) for b in codebooks]
    sums = [[[0] * len(e) for e in b] for b in codebooks]
    counts = [np.zeros(len(b), np.int64) for b in books]
    seen = False
    for batch in batches:
        for raw, packed in zip(batch["_points"].to_pylist(), batch["_trees"].to_pylist()):
            seen = True
            for part, (points, tree) in enumerate(zip(_points_of(raw), _trees_of(packed))):
                for what, entry in tree.settle_entries(books[part], points):
                    for k in np.unique(entry):
                        own = what[entry == k]
                        balls, rows = own[own >= 0], ~own[own < 0]
                        counts[part][k] += int((tree.high[balls] - tree.low[balls]).sum()) + len(rows)
                        total = tree.total[balls].sum(axis=0) + points[rows].sum(axis=0)
                        sums[part][k] = [int(a) + int(b) for a, b in zip(sums[part][k], total)]
    if seen:
        cells = [
            (p, k, i, j, x, int(counts[p][k])) for p, b in enumerate(sums) for k, e in enumerate(b) if counts[p][k]
            for i, total in enumerate(e) for j, x in enumerate(limbs(total))
        ]
        if cells:
            yield dict(zip(("_part", "_entry", "_at", "_limb", "_sum", "_count"), map(list, zip(*cells))))


def limbs(total: int) -> list[int]:
    """Digits of 40 bits, the lowest first, with the sign of the number: they add up in 64 bits over many tasks."""
    sign, left, out = (-1 if total < 0 else 1), abs(total), []
    while left or not out:
        out.append(sign * (left & (1 << 40) - 1))
        left >>= 40
    return out


def _integers(values: list[list[int]]) -> np.ndarray:
    """Exact in 64 bits if all components are small, else Python's integers."""
    if all(abs(x) < EXACT for row in values for x in row):
        return np.array(values, np.int64)
    return np.array(values, object)


def _assign(batches: Iterator[dict], codebooks: list[list[list[int]]]) -> Iterator[dict]:
    books = [_integers(b) for b in codebooks]
    for batch in batches:
        for ids, labels, raw, packed in zip(*(batch[c].to_pylist() for c in ("_ids", "_labels", "_points", "_trees"))):
            codes = np.zeros((len(ids), len(books)), np.int64)
            error = np.zeros(len(ids), np.int64)
            for part, (points, tree) in enumerate(zip(_points_of(raw), _trees_of(packed))):
                for what, entry in tree.settle_entries(books[part], points):
                    for ball, k in zip(what[what >= 0], entry[what >= 0]):
                        codes[tree.order[tree.low[ball]:tree.high[ball]], part] = k
                    codes[~what[what < 0], part] = entry[what < 0]
                error = error + squared(points, books[part][codes[:, part]])
            errors = [e if abs(e) < 1 << 63 else None for e in map(int, error)]
            yield {"vec_id": ids, "_label": labels, "code": [bytes(c).hex() for c in codes.astype(np.uint8)], "error": errors}


def _means(sent: DataFrame, codebooks: list[list[list[int]]]) -> list[list[list[int]]]:
    """The next codebooks: floors of the means; entries without points stay. A row per component comes to the driver."""
    out = [[list(e) for e in b] for b in codebooks]
    sums, counts = {}, {}
    for part, entry, at, limb, total, count in sent.groupBy("_part", "_entry", "_at", "_limb").agg(F.sum("_sum"), F.sum("_count")).collect():
        sums[part, entry, at] = sums.get((part, entry, at), 0) + (total << 40 * limb)
        counts[part, entry] = max(count, counts.get((part, entry), 0))  # every task tells the lowest digits
    for (part, entry, at), total in sums.items():
        out[part][entry][at] = total // counts[part, entry]
    return out


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, list[list[list[int]]]]:
    """(vec_id, _label, code, error) for every kept row of ``vectors``, and the codebooks by part."""
    spark = vectors.sparkSession
    narrow = vectors.select(
        vectors[id_col].cast("bigint").alias("_id"), vectors[vector_col].cast("array<double>").alias("_vector"),
        vectors[label_col].cast("string").alias("_label"),
    ).filter("_vector IS NOT NULL AND forall(_vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    order = [F.col("_id").asc_nulls_last(), "_vector"]
    first = narrow.orderBy(*order).select(F.size("_vector").alias("n")).first()
    length = first.n if first else 0
    start = narrow.filter(F.size("_vector") == length).orderBy(*order).limit(entries).collect()
    matrix = [[int(x) for x in floors(r._vector, scale)] + [0] * (-length % parts) for r in start]
    width = (length + -length % parts) // parts
    codebooks = [[row[p * width:(p + 1) * width] for row in matrix] for p in range(parts)]
    schema = "_ids array<bigint>, _labels array<string>, _points binary, _trees binary"
    blocks = settle(map_batches(narrow, _pack, schema, length=length, parts=parts, scale=scale), "blocks")
    for _ in range(rounds):
        sent = map_batches(blocks.select("_points", "_trees"), _one_round, "_part int, _entry int, _at int, _limb int, _sum bigint, _count bigint", codebooks=codebooks)
        codebooks = _means(sent, codebooks)
    return map_batches(blocks, _assign, "vec_id bigint, _label string, code string, error bigint", codebooks=codebooks), codebooks


def codebooks_digest(codebooks: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for book in codebooks for entry in book for x in entry).encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Add ``label_error``, the errors of equal labels together; nulls are one label."""
    grain = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_grain")  # were labels many, one may still hold a third of all rows
    sums = codes.groupBy("_label").agg(F.sum("error").alias("label_error"))
    few, _ = bounded(sums.select(F.col("_label").alias("_of"), "label_error", grain))
    salted = codes.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return salted.join(few, F.col("_label").eqNullSafe(F.col("_of")) & (F.col("_salt") == F.col("_grain"))).drop("_of", "_salt", "_grain")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, codebooks = compress(table(spark, sf_dir, "embeddings"))
    return with_label_errors(settle(codes, "codes")).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256")
    )


def _sql() -> str:
    away = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [f"""k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
  list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"p AS MATERIALIZED (SELECT r, q, v[q * (len(v) // {PARTS}) + 1:(q + 1) * (len(v) // {PARTS})] AS v FROM k, range({PARTS}) t(q))",
        f"c0 AS MATERIALIZED (SELECT q, r - 1 AS e, v AS c FROM p WHERE r <= {ENTRIES})"]
    for n in range(ROUNDS + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT r, q, any_value(v) AS v, arg_min(e, d * {ENTRIES} + e) AS e, min(d) AS d
  FROM (SELECT r, q, v, e, {away} AS d FROM p JOIN c{n} USING (q)) GROUP BY r, q)""")
        if n < ROUNDS:
            steps.append(f"""m{n} AS (SELECT q, e, list(x ORDER BY i) AS c FROM (SELECT q, e, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x
  FROM (SELECT q, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n}) GROUP BY q, e, i) GROUP BY q, e)""")
            steps.append(f"c{n + 1} AS MATERIALIZED (SELECT q, e, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (q, e))")
    return "WITH " + ",\n".join(steps) + f""",
f AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY q) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  sha256((SELECT string_agg(array_to_string(c, ','), ',' ORDER BY q, e) FROM c{ROUNDS})) AS codebooks_sha256
FROM f JOIN k USING (r)"""


OP12_SQL = _sql()
