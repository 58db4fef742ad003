"""Embedding near-duplicates by sorted projection passes (operator 3).

In each pass a vector gets a hash of concatenated random hyperplane bits, and the
vectors of a label are ordered by it.  A vector is compared with a window of the
order: its next ``WINDOW`` rows, and further ones as long as they share its first
``bits`` bits (a run).  Two vectors share these bits with a probability that
depends on their angle alone, so passes are added until a pair at the threshold
shares them in none with probability below ``MISS``; this holds for any data, as
every run is compared whole.  The number of bits follows from counts of the rows a
run holds, not from the number of vectors alone: vectors in a cone share many bits,
and more bits and passes are cheaper there than long runs.  Rows are sorted within
zones, the prefixes a few bits shorter than a run's, so a run is never cut; runs
over a block are compared by pairs of blocks.

Dense groups are joined first: in ``SEED`` passes, with windows of ``WINDOW`` rows
alone, the rows are range-partitioned and sorted by (pass, label, hash), and rows at
partition ends are compared with the start of the next partition in a second small
step.  What is joined then needn't be compared again, so a run costs its largest
component times the rest.

Verified pairs of all passes are united to components.  Within a component all
pairs are then compared in blocks, so no link inside it is lost.  Equal vectors
are collapsed first and counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import grouped_rows, stored, trimmed

THRESHOLD = 0.98
WINDOW = 24
MISS = 1e-3
BITS = 62
#: passes of narrow windows that join dense groups before whole runs are compared
SEED = 4
#: rows of a run when hashes are spread evenly; bits added at a time where they aren't
EVEN = 256
STEP = 4
#: bits by which a zone's prefix is shorter than a run's
ZONE = 4
#: passes counted to choose the bits, and the comparisons that cost as much as a row of a pass
TRIALS = 3
ROW_COST = 1000
#: rows of one block of the all-pairs steps
BLOCK = 2048


def bits_for(n: int) -> int:
    """Bits that leave ``EVEN`` rows or fewer a run if hashes are spread evenly."""
    return max(1, math.ceil(math.log2(max(n, 2) / EVEN)))


def passes_at(bits: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Passes until a pair at the threshold shares no run with probability below ``miss``."""
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return max(4, math.ceil(math.log(miss) / math.log(1 - agree)))


def passes_for(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """The passes of ``n`` vectors whose hashes are spread evenly."""
    return passes_at(bits_for(n), threshold, miss)


def _planes(step: int, dim: int) -> np.ndarray:
    return np.random.default_rng([step, dim]).standard_normal((dim, BITS))


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, vec): vec holds the components as doubles, null if the row can't link."""
    for batch in batches:
        out = []
        for v, label in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if v is None or label is None or not len(v) or None in v:
                out.append(None)
                continue
            x = np.asarray(v, np.float64) + 0.0
            size = np.abs(x).max()
            out.append(x.tobytes() if np.isfinite(size) and size > 0 else None)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["vec_id", "label", "vec"])


def _matrix(col) -> np.ndarray:
    """Rows of equal length as unit vectors."""
    x = np.frombuffer(b"".join(col.to_pylist()), np.float64).reshape(len(col), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hashed(n_passes: int, with_vec: bool = True):
    """(pass, label, dim, hash, cls, component[, vec]) for every pass (rows cls, label, vec, component)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(2).to_pylist()], np.int64)
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                cls, label, vec, component = part.columns
                x = _matrix(vec)
                for step in range(n_passes):
                    h = ((x @ _planes(step, x.shape[1])) > 0) @ weights
                    cols = [pa.array(np.full(len(x), step, np.int32)), label, pa.array(np.full(len(x), x.shape[1], np.int32)),
                            pa.array(h), cls, component]
                    names = ["pass", "label", "dim", "hash", "cls", "component"]
                    yield pa.record_batch([*cols, vec] if with_vec else cols, names=[*names, "vec"] if with_vec else names)

    return run


_HASHED = "pass int, label string, dim int, hash long, cls long, component long"
_FOUND = "a long, b long, pid int, side string, pass int, label string, dim int, place int, vec binary"


def _groups(batch: pa.RecordBatch) -> np.ndarray:
    """True where a row starts another (pass, label, dim)."""
    new = np.zeros(batch.num_rows, bool)
    for name in ("pass", "label", "dim"):
        v = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
        new[1:] |= v[1:] != v[:-1]
    return new


def _window_pairs(batch: pa.RecordBatch, threshold: float, window: int, old: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Components with a linked pair at most ``window`` rows apart, the later row being at ``old`` or after."""
    group = np.cumsum(_groups(batch))
    ids = batch.column(batch.schema.get_field_index("component")).to_numpy()
    vec = batch.column(batch.schema.get_field_index("vec"))
    a, b = [], []
    for g in np.unique(group):
        at = np.flatnonzero(group == g)
        lo, hi = int(at[0]), int(at[-1]) + 1
        x = _matrix(vec.slice(lo, hi - lo))
        for d in range(1, min(window, len(x) - 1) + 1):
            near = np.einsum("ij,ij->i", x[:-d], x[d:]) >= threshold
            near &= (np.arange(lo + d, hi) >= old) & (ids[lo:hi - d] != ids[lo + d:hi])
            hit = np.flatnonzero(near) + lo
            a.append(ids[hit])
            b.append(ids[hit + d])
    none = np.zeros(0, np.int64)
    return _spanning(np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links that join something not joined by those before them: a dense group sends
    one link a row instead of all its pairs."""
    up: dict[int, int] = {}
    keep = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        while (p := up.setdefault(x, x)) != x:
            up[x] = x = up[p]
        while (p := up.setdefault(y, y)) != y:
            up[y] = y = up[p]
        if x != y:
            up[y] = x
            keep.append(k)
    return a[keep], b[keep]


def _found(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    names = [f.split()[0] for f in _FOUND.split(", ")]
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()),
                            pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()),
                            pa.nulls(n, pa.binary())], names=names)


def _edge(batch: pa.RecordBatch, pid: int, side: str) -> pa.RecordBatch:
    n = batch.num_rows
    col = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
    return pa.record_batch([col["component"], pa.nulls(n, pa.int64()), pa.array([pid] * n, pa.int32()), pa.array([side] * n),
                            col["pass"], col["label"], col["dim"], pa.array(range(n), pa.int32()), col["vec"]],
                           names=[f.split()[0] for f in _FOUND.split(", ")])


def _pass_pairs(threshold: float, window: int):
    """Pairs inside windows of ``window`` rows, and the rows at the ends of the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, held, begun = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                if begun < window:
                    head = part.slice(0, window - begun)
                    yield _edge(head, pid, "first")
                    begun += head.num_rows
                old = 0
                if held is not None:
                    old = held.num_rows
                    part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
                yield _found(*_window_pairs(part, threshold, window, old))
                held = part.slice(max(0, part.num_rows - window))
        if held is not None:
            yield _edge(held, pid, "last")

    return run


def _junction_pairs(threshold: float, window: int):
    """Pairs between the end of a partition and the start of the next (rows sorted by junction, side, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped_rows(batches, "junction"):
            rows = group.combine_chunks().to_batches()[0]
            last = sum(s == "0last" for s in rows.column(rows.schema.get_field_index("side")).to_pylist())
            if 0 < last < rows.num_rows:
                a, b = _window_pairs(rows, threshold, window, last)
                yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


_RUN = ["pass", "label", "dim", "run"]


def _with_runs(rows: DataFrame, n_passes: int, bits: int, with_vec: bool) -> DataFrame:
    """The rows of every pass with ``run``, the first ``bits`` bits of their hash."""
    return (rows.select("cls", "label", "vec", "component")
            .mapInArrow(trimmed(_hashed(n_passes, with_vec)), _HASHED + (", vec binary" if with_vec else ""))
            .withColumn("run", F.shiftright("hash", BITS - bits)))


def _run_counts(rows: DataFrame, n_passes: int, bits: int) -> DataFrame:
    """Per run: n rows, the largest component ``big`` with ``m`` of them, and the ``rest``."""
    return (_with_runs(rows, n_passes, bits, False)
            .groupBy(*_RUN, "component").agg(F.count("*").alias("m"))
            .groupBy(*_RUN).agg(F.sum("m").alias("n"), F.max(F.struct("m", "component")).alias("most"))
            .select(*_RUN, "n", F.col("most.component").alias("big"), F.col("most.m").alias("m"), (F.col("n") - F.col("most.m")).alias("rest")))


def _chosen_bits(rows: DataFrame, n: int, threshold: float) -> int:
    """The bits whose passes cost least, rows and comparisons counted."""

    def compared(bits: int) -> float:
        total = _run_counts(rows, TRIALS, bits).agg(F.sum(F.col("rest").cast("double") * F.col("n"))).first()[0]
        return (total or 0.0) / TRIALS

    bits = bits_for(n)
    pairs = compared(bits)
    while pairs > ROW_COST * n and bits + STEP <= BITS:
        fewer = compared(bits + STEP)
        if passes_at(bits + STEP, threshold) * (ROW_COST * n + fewer) >= passes_at(bits, threshold) * (ROW_COST * n + pairs):
            break
        bits, pairs = bits + STEP, fewer
    return bits


def _linked(x: np.ndarray, component: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Distinct pairs of different components with a link between rows ``left`` and rows ``right``."""
    found = [np.zeros((0, 2), np.int64)]
    for at in range(0, len(left), 512):
        rows = left[at:at + 512]
        i, j = np.nonzero(x[rows] @ x[right].T >= threshold)
        ends = np.stack([component[rows[i]], component[right[j]]], axis=1)
        ends = np.sort(ends[ends[:, 0] != ends[:, 1]], axis=1)
        found.append(np.unique(ends, axis=0))
    return np.concatenate(found)


def _whole_runs(batches: Iterator[pa.RecordBatch], shift: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The sorted rows again in batches that end where a run ends, with the starts of their runs."""
    held = None
    for batch in batches:
        if held is not None and held.num_rows:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if batch.num_rows == 0:
            continue
        run = batch.column(batch.schema.get_field_index("hash")).to_numpy() >> shift
        new = _groups(batch)
        new[1:] |= run[1:] != run[:-1]
        new[0] = True
        starts = np.flatnonzero(new)
        held = batch.slice(int(starts[-1]))
        if len(starts) > 1:
            yield batch.slice(0, int(starts[-1])), starts[:-1]
    if held is not None:
        yield held, np.zeros(1, np.int64)


def _run_pairs(threshold: float, window: int, shift: int):
    """(a, b): components linked inside a window: the next ``window`` rows of the order, and the
    whole run (rows sorted by pass, label, dim and hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch, starts in _whole_runs(batches, shift):
            component = batch.column(batch.schema.get_field_index("component")).to_numpy()
            vec = batch.column(batch.schema.get_field_index("vec"))
            found = [np.zeros((0, 2), np.int64)]
            for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
                if hi - lo <= window + 1:
                    continue  # the next rows of the order are all of it
                of = component[lo:hi]
                names, counts = np.unique(of, return_counts=True)
                if len(names) > 1:
                    rest = np.flatnonzero(of != names[counts.argmax()])
                    found.append(_linked(_matrix(vec.slice(lo, hi - lo)), of, rest, np.arange(len(of)), threshold))
            for at in range(0, batch.num_rows, 4096):
                part, old = batch.slice(at, 4096), 0
                if held is not None:
                    old = held.num_rows
                    part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
                found.append(np.stack(_window_pairs(part, threshold, window, old), axis=1))
                held = part.slice(max(0, part.num_rows - window))
            ends = np.concatenate(found)
            if len(ends):
                a, b = _spanning(ends[:, 0], ends[:, 1])
                yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _dealt_links(threshold: float):
    """(a, b): components linked inside a block of a long run or between two (rows own, low, high, component, vec)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped_rows(batches, "key"):
            component = group.column("component").to_numpy()
            names, counts = np.unique(component, return_counts=True)
            if len(names) == 1:
                continue
            own, low, high = (group.column(c).to_numpy() for c in ("own", "low", "high"))
            if low[0] == high[0]:
                left, right = np.flatnonzero(component != names[counts.argmax()]), np.arange(len(component))
            else:
                left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
            ends = _linked(_matrix(group.column("vec").combine_chunks()), component, left, right, threshold)
            if len(ends):
                a, b = _spanning(ends[:, 0], ends[:, 1])
                yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def pass_links(rows: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(a, b) components of ``rows`` (cls, label, vec, component) that some window of some pass links.

    A run over ``block`` rows is dealt into blocks, those outside its largest
    component first; only pairs of blocks with one of these are compared.
    """
    bits = _chosen_bits(rows, rows.count(), threshold)
    steps = passes_at(bits, threshold)
    large = stored(_run_counts(rows, steps, bits).where(F.col("n") > block)
                   .select(*_RUN, "big", "rest", F.ceil(F.col("rest") / block).cast("int").alias("few"),
                           F.ceil(F.col("m") / block).cast("int").alias("many")))
    ordered = _with_runs(rows, steps, bits, True)
    links = (ordered.join(large, _RUN, "left_anti")
             .repartition("pass", "label", "dim", F.shiftright("run", ZONE))
             .sortWithinPartitions("pass", "label", "dim", "hash", "cls")
             .mapInArrow(trimmed(_run_pairs(threshold, window, BITS - bits)), "a long, b long"))
    if large.isEmpty():
        return links
    deal, of_big = F.xxhash64("cls"), F.col("component") == F.col("big")
    dealt = (ordered.join(large.where("rest > 0"), _RUN)
             .withColumn("own", F.when(of_big, F.col("few") + F.pmod(deal, F.col("many"))).otherwise(F.pmod(deal, F.col("few"))).cast("int"))
             .withColumn("other", F.explode(F.when(of_big, F.sequence(F.lit(0), F.col("few") - 1))
                                            .otherwise(F.sequence(F.lit(0), F.col("few") + F.col("many") - 1))))
             .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
             .select(F.concat_ws("|", "pass", "dim", "run", "low", "high", "label").alias("key"), "low", "high", "own", "component", "vec"))
    return links.union(dealt.repartition("key").sortWithinPartitions("key").mapInArrow(trimmed(_dealt_links(threshold)), "a long, b long"))


def _block_links(threshold: float):
    """(cls, links) inside a block or between two (rows component, low, high, own, cls, n, vec)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped_rows(batches, "key"):
            ids, n = group.column("cls").to_numpy(), group.column("n").to_numpy()
            own, low = group.column("own").to_numpy(), group.column("low").to_numpy()
            high = group.column("high").to_numpy()
            x = _matrix(group.column("vec").combine_chunks())
            left = np.flatnonzero(own == low)
            right = np.flatnonzero(own == high)
            links = np.zeros(len(ids), np.int64)
            same = low[0] == high[0]
            for at in range(0, len(left), 512):
                rows = left[at:at + 512]
                near = x[rows] @ x[right].T >= threshold
                if same:
                    near[np.arange(len(rows)), np.arange(at, at + len(rows))] = False
                links[rows] += near @ n[right]
                if not same:
                    links[right] += n[rows] @ near
            yield pa.record_batch([pa.array(ids), pa.array(links)], names=["cls", "links"])

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing, as do rows with a null label or id; only vectors of equal
    label and length are compared; equal vectors link; rows that repeat an id are
    one node of the components; other columns aren't read; an empty table gives
    no rows.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                          F.col(f"`{vec_col}`").alias("embedding"))
    clean = stored(rows.mapInArrow(trimmed(_clean), "vec_id long, label string, vec binary"))
    usable = clean.where("vec is not null and vec_id is not null")
    classes = stored(usable.groupBy("label", "vec").agg(F.min("vec_id").alias("cls"), F.count("*").alias("n")))
    found = stored(classes.select("cls", "label", "vec", F.col("cls").alias("component"))
                   .mapInArrow(trimmed(_hashed(SEED)), _HASHED + ", vec binary")
                   .repartitionByRange("pass", "label", "dim", "hash", "cls")
                   .sortWithinPartitions("pass", "label", "dim", "hash", "cls")
                   .mapInArrow(trimmed(_pass_pairs(threshold, window)), _FOUND))
    ends = found.where("side is not null")
    # one row per partition: the partition that follows it among those with rows
    order = ends.select("pid").distinct().selectExpr("pid", "lag(pid) over (order by pid) as junction")
    firsts = ends.where("side = 'first'").join(F.broadcast(order), "pid").where("junction is not null")
    lasts = ends.where("side = 'last'").withColumn("junction", F.col("pid"))
    cols = ["junction", "pass", "label", "dim", "place", F.col("a").alias("component"), "vec"]
    edges = (lasts.select(F.lit("0last").alias("side"), *cols).union(firsts.select(F.lit("1first").alias("side"), *cols))
             .repartition("junction").sortWithinPartitions("junction", "side", "place")
             .mapInArrow(trimmed(_junction_pairs(threshold, window)), "a long, b long"))
    links = found.where("side is null").select("a", "b").union(edges)
    joined = stored(components(links).select(F.col("node").alias("cls"), "component"))
    rows = stored(classes.join(joined, "cls", "left").select("cls", "label", "vec", F.coalesce("component", "cls").alias("component")))
    links = joined.select(F.col("cls").alias("a"), F.col("component").alias("b")).union(pass_links(rows, threshold, window, block))
    groups = stored(components(links).select(F.col("node").alias("cls"), "component"))

    members = classes.join(groups, "cls")
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    blocks = (members.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
              .select(F.xxhash64("component", "low", "high").alias("key"), "low", "high", "own", "cls", "n", "vec")
              .repartition("key").sortWithinPartitions("key"))
    counted = blocks.mapInArrow(trimmed(_block_links(threshold)), "cls long, links long").groupBy("cls").agg(F.sum("links").alias("links"))
    by_class = (classes.join(groups, "cls", "left").join(counted, "cls", "left")
                .select("label", "vec", F.coalesce("component", "cls").alias("component_id"),
                        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    return (clean.join(by_class, ["label", "vec"], "left")
            .select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
                    F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
