"""Exact n-gram Jaccard join with prefix filters under several global token orders.

A token is the hash of a word shingle. All orders rank tokens of few documents first, and differ
among tokens of similar frequency. Two sets whose similarity reaches the threshold share all but a
few of their tokens; tokens that no other document holds come first of all, so documents with too
many of those are done after the pass that counts tokens. The others are grouped by shared prefix
tokens under one order; inside a group, pairs must share prefix tokens under all orders before their
sets are compared.

Nothing enumerates the pairs of a group: equal sets are one class, groups are linked through their
smallest member, and a class that is connected already is not compared with its component again.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.llm import shared, words
from lexiframe.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tokens are hashes of this many bits. They are only ever compared within pairs of documents and,
#: to find tokens held once, within the corpus, where a collision costs a comparison and no link.
#: Two of n shingles of a pair are taken for one with a chance below n^2 / 2^61.
TOKEN_BITS = 60
#: Once counted, a token also carries the logarithm of its document frequency, up to this class.
TOP_CLASS = 8
_WIDTH = 8  # bytes of a token with its class
#: Tokens that a task gathers before it sends them.
FLUSH_TOKENS = 1 << 19
#: Tokens of one verification task; larger groups are dealt with block by block.
BLOCK_TOKENS = 2 << 20
#: Tokens of candidates that are compared in one step.
STEP_TOKENS = 1 << 18
ORDERS = 3
#: A row's number is (task, chunk, place): these are the bits of a place, and of a chunk of a task.
PLACE_BITS, CHUNK_BITS = 23, 20
#: Chunks of one flush at most, so that a reference to a row fits into 32 bits.
FLUSH_CHUNKS = 256

_TOKENS = "bucket long, tokens binary, refs binary, n long, rids array<long>, ids array<long>, sizes array<int>, d1 array<long>, d2 array<long>"


def token_sets(data: np.ndarray, offsets: np.ndarray, shingle: int):
    """Distinct tokens of each text, sorted within it: tokens, text of each token."""
    folded = words.LOWER[data]
    starts, ends, firsts = words.split(folded, offsets)
    hashed = words.hashes(folded, starts, ends)
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    grams = words.grams(hashed, shingle)
    inside = text_of[: len(grams)] == text_of[shingle - 1 :] if len(grams) else np.empty(0, bool)
    tokens, owners = [grams[inside]], [text_of[: len(grams)][inside]]
    counts = np.diff(firsts)
    for n in range(1, shingle):  # a shorter text is one token as a whole
        short = np.flatnonzero(counts == n)
        if len(short):
            tokens.append(words.grams(hashed, n)[firsts[short]] ^ np.uint64(n))
            owners.append(short)
    token = np.concatenate(tokens) >> np.uint64(64 - TOKEN_BITS)
    owner = np.concatenate(owners)
    order = np.lexsort((token, owner))
    token, owner = token[order], owner[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    return token[new], owner[new]


def _pack(values: np.ndarray) -> bytes:
    """Byte planes of unsigned numbers, so that bytes that are mostly zero lie together."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(data, n * width, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(kind).ravel()


_SCHEMA = pa.schema(
    [("bucket", pa.int64()), ("tokens", pa.binary()), ("refs", pa.binary()), ("n", pa.int64())]
    + [("rids", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))]
    + [("d1", pa.list_(pa.int64())), ("d2", pa.list_(pa.int64()))]
)


class _Sender:
    """Tokens of one task by bucket. Tokens that a flush holds often enough for the top class need
    no counting: their documents are told at once, by way of any bucket, and one entry without a
    document goes to the token's bucket."""

    def __init__(self, shingle: int, buckets: int):
        self.shingle, self.buckets, self.chunk = shingle, buckets, 0
        self.base = TaskContext.get().partitionId() << (PLACE_BITS + CHUNK_BITS)
        self.clear()

    def clear(self) -> None:
        self.held, self.tokens, self.owners = 0, [], []
        self.first = self.chunk

    def full(self) -> bool:
        return self.held > FLUSH_TOKENS or self.chunk - self.first >= FLUSH_CHUNKS

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = shared.text_bytes(batch.column("_text"))
        token, owner = token_sets(data, offsets, self.shingle)
        sizes = np.bincount(owner, minlength=batch.num_rows)
        edges = np.concatenate(([0], np.cumsum(sizes)))
        digests = []
        for seed in (1, 2):
            total = np.zeros(len(token) + 1, np.uint64)
            np.cumsum(words.mix(token + np.uint64(seed << 50)), out=total[1:])
            digests.append((total[edges[1:]] - total[edges[:-1]]).view(np.int64))
        rids = self.base + (self.chunk << PLACE_BITS) + np.arange(batch.num_rows)
        row = {
            "bucket": int(self.chunk % self.buckets),
            "rids": rids.tolist(),
            "ids": batch.column("_id").to_pylist(),
            "sizes": sizes.tolist(),
            "d1": digests[0].tolist(),
            "d2": digests[1].tolist(),
        }
        yield pa.RecordBatch.from_pylist([row], _SCHEMA)
        self.tokens.append(token)
        self.owners.append((((self.chunk - self.first) << PLACE_BITS) + owner).astype(np.uint32))
        self.chunk += 1
        self.held += len(token)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return self.clear()
        token, owner = np.concatenate(self.tokens), np.concatenate(self.owners)
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        bucket = (token % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        token, owner = token[order], owner[order]
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for b, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
            if low == high:
                continue
            own, refs = token[low:high], owner[low:high].astype(np.uint64) + np.uint64(1)
            starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            sizes = np.diff(np.append(starts, len(own)))
            often = sizes >= 1 << TOP_CLASS
            top = np.repeat(often, sizes)
            place = (b + self.first) % self.buckets
            yield from self._send(place, own[top], refs[top], known=True)
            # 0 refers to no document: the token stands for those that are told already.
            marks = np.zeros(int(often.sum()), np.uint64)
            tokens = np.concatenate((own[~top], own[starts[often]]))
            order = np.argsort(tokens, kind="stable")
            entries = np.concatenate((refs[~top], marks))[order]
            yield from self._send(b, tokens[order], entries, known=False)
        self.clear()
        pa.default_memory_pool().release_unused()

    def _send(self, bucket: int, own: np.ndarray, refs: np.ndarray, known: bool):
        if not len(own):
            return
        row = {
            "bucket": bucket,
            "tokens": _pack(np.diff(own, prepend=np.uint64(0))),
            "refs": _pack(refs.astype(np.uint32)),
            "n": -len(own) if known else len(own),
            "rids": [int(self.base + (self.first << PLACE_BITS)) - 1],
        }
        yield pa.RecordBatch.from_pylist([row], _SCHEMA)


def _by_chunk(rid: np.ndarray, token: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A bucket's repeated tokens, one packed row for each chunk of rows that holds some."""
    chunk = rid >> PLACE_BITS
    order = np.lexsort((token, chunk))
    rid, token, chunk = rid[order], token[order], chunk[order]
    edges = np.flatnonzero(np.concatenate((np.ones(len(rid[:1]), bool), chunk[1:] != chunk[:-1])))
    for low, high in zip(edges, [*edges[1:], len(rid)]):
        row = {
            "bucket": int(chunk[low]),
            "tokens": _pack(np.diff(token[low:high], prepend=np.uint64(0))),
            "refs": _pack((rid[low:high] & ((1 << PLACE_BITS) - 1)).astype(np.uint32)),
            "n": int(high - low),
        }
        yield pa.RecordBatch.from_pylist([row], _SCHEMA)


def _repeated(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    tokens, rids = [], []
    for row in rows:
        if row["tokens"] is None:
            yield pa.RecordBatch.from_pylist([row | {"bucket": row["rids"][0] >> PLACE_BITS}], _SCHEMA)
            continue
        n = abs(row["n"])
        own = np.cumsum(_unpack(row["tokens"], n, np.uint64), dtype=np.uint64)
        refs = _unpack(row["refs"], n, np.uint32).astype(np.int64)
        rid = np.where(refs > 0, refs + row["rids"][0], -1)
        if row["n"] < 0:
            yield from _by_chunk(rid, own | np.uint64(TOP_CLASS << TOKEN_BITS))
        else:
            tokens.append(own)
            rids.append(rid)
    if not tokens:
        return
    token, rid = np.concatenate(tokens), np.concatenate(rids)
    order = np.argsort(token, kind="stable")
    token, rid = token[order], rid[order]
    starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    sizes = np.diff(np.append(starts, len(token)))
    held = np.add.reduceat((rid >= 0).astype(np.int64), starts)
    held[np.add.reduceat((rid < 0).astype(np.int64), starts) > 0] = 1 << TOP_CLASS
    classes = np.minimum(np.log2(held).astype(np.uint64), np.uint64(TOP_CLASS))
    told = np.repeat(held > 1, sizes) & (rid >= 0)
    token = token | np.repeat(classes << np.uint64(TOKEN_BITS), sizes)
    yield from _by_chunk(rid[told], token[told])


def _gathered(rows: list[dict], percent: int) -> Iterator[pa.RecordBatch]:
    """The rows of a chunk, with their repeated tokens where these can reach the threshold."""
    (head,) = [row for row in rows if row["tokens"] is None]
    own = [row for row in rows if row["tokens"] is not None]
    tokens = [np.cumsum(_unpack(row["tokens"], row["n"], np.uint64), dtype=np.uint64) for row in own]
    places = [_unpack(row["refs"], row["n"], np.uint32).astype(np.int64) for row in own]
    token = np.concatenate([np.empty(0, np.uint64), *tokens])
    place = np.concatenate([np.empty(0, np.int64), *places])
    n = np.array(head["sizes"], np.int64)
    counts = np.bincount(place, minlength=len(n))
    enough = (n > 0) & (counts * 100 >= n * percent)
    kept = enough[place]
    order = np.argsort(place[kept], kind="stable")
    width = token[kept][order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_WIDTH]
    offsets = np.concatenate(([0], np.cumsum(np.where(enough, counts, 0)))) * _WIDTH
    valid = np.packbits(enough, bitorder="little")
    values = pa.Array.from_buffers(
        pa.large_binary(),
        len(n),
        [pa.py_buffer(valid), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(width))],
    ).cast(pa.binary())
    columns = [head[c] for c in ("rids", "ids", "sizes", "d1", "d2")]
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
    whole = pa.RecordBatch.from_arrays([*map(pa.array, columns, types), values], ["_rid", "_id", "n", "d1", "d2", "tokens"])
    for first in range(0, len(n), 500):
        yield whole.slice(first, 500)


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one bucket, or of one chunk, which lie together."""
    current, rows = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["bucket"] != current and rows:
                yield rows
                rows = []
            current = row["bucket"]
            rows.append(row)
    if rows:
        yield rows


def _tokens(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // _WIDTH, 8), np.uint8)
    out[:, :_WIDTH] = np.frombuffer(data, np.uint8).reshape(-1, _WIDTH)
    return out.view("<u8").ravel().astype(np.uint64)


def repeated_tokens(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(_rid, _id, n, d1, d2, tokens) of each row; tokens only where they can reach the threshold."""
    parts = shared.shuffle_partitions(docs.sparkSession)
    buckets = parts * 4

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(shingle, buckets)
        for batch in batches:
            for part in shared.slices(batch, "_text", shared.BLOCK_BYTES // 2):
                yield from sender.add(part)
                if sender.full():
                    yield from sender.flush()
        yield from sender.flush()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches):
            yield from _repeated(rows)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches):
            yield from _gathered(rows, percent)

    def together(frame: DataFrame) -> DataFrame:
        return frame.repartition(parts, "bucket").sortWithinPartitions("bucket")

    found = together(docs.mapInArrow(send, _TOKENS)).mapInArrow(find, _TOKENS)
    return together(found).mapInArrow(gather, "_rid long, _id long, n int, d1 long, d2 long, tokens binary")


def _needed(n, percent: int):
    """Fewest tokens that a set of n must share with another to be linked."""
    return (n * percent + 99) // 100


def _ranked(tokens: np.ndarray, order: int) -> np.ndarray:
    """The tokens in the global order of this number: rare classes first, then by its own hash."""
    mixed = words.mix(tokens + np.uint64((order + 1) << 56))
    return tokens[np.lexsort((mixed, tokens >> np.uint64(TOKEN_BITS)))]


class Verifier:
    """Components of the classes of one task: `left` against itself, or against `right`.

    label: classes of equal label are connected already and are not compared.
    """

    def __init__(self, percent: int, orders: int = ORDERS):
        self.percent, self.orders = percent, orders
        self.verified = 0

    def links(self, sets: list[np.ndarray], sizes: np.ndarray, label: np.ndarray, left: np.ndarray):
        """Links (i, j) that connect what is connected; a pair has at least one class in `left`."""
        count = len(sets)
        prefixes = [[] for _ in range(self.orders)]
        for tokens, n in zip(sets, sizes):
            length = max(len(tokens) - _needed(int(n), self.percent) + 1, 0)
            for k in range(self.orders):
                prefixes[k].append(_ranked(tokens, k)[:length])
        postings = []
        for own in prefixes:
            token = np.concatenate(own)
            owner = np.repeat(np.arange(count), [len(x) for x in own])
            order = np.argsort(token, kind="stable")
            postings.append((token[order], owner[order]))
        parent = np.unique(label, return_inverse=True)[1]
        found = []
        waiting = np.ones(count, bool)  # not yet compared with all others
        queue: list[int] = []
        rest = iter(np.argsort(-sizes, kind="stable").tolist())
        while True:
            seed = next((x for x in self._pop(queue, waiting)), None)
            if seed is None:
                seed = next((x for x in rest if waiting[x]), None)
            if seed is None:
                return found
            waiting[seed] = False
            other = waiting & (parent != parent[seed])
            if not left[seed]:
                other &= left
            if not other.any():
                continue
            mask = other
            for k in range(self.orders):
                token, owner = postings[k]
                own = prefixes[k][seed]
                low, high = np.searchsorted(token, own), np.searchsorted(token, own, "right")
                hit = np.zeros(count, bool)
                for a, b in zip(low, high):
                    hit[owner[a:b]] = True
                mask = mask & hit
            candidates = np.flatnonzero(mask)
            if not len(candidates):
                continue
            self.verified += len(candidates)
            common = self._common(np.sort(sets[seed]), [sets[c] for c in candidates])
            union = sizes[seed] + sizes[candidates] - common
            for c in candidates[100 * common >= self.percent * union].tolist():
                if parent[c] != parent[seed]:
                    found.append((seed, c))
                    parent[parent == parent[c]] = parent[seed]
                    queue.append(c)

    @staticmethod
    def _common(base: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
        """How many tokens each of the others shares with the sorted base."""
        out, first = np.zeros(len(others), np.int64), 0
        while first < len(others):
            last, held = first, 0
            while last < len(others) and (last == first or held + len(others[last]) <= STEP_TOKENS):
                held += len(others[last])
                last += 1
            flat = np.concatenate(others[first:last])
            at = np.minimum(np.searchsorted(base, flat), len(base) - 1)
            shares = np.concatenate(([0], np.cumsum(base[at] == flat)))
            stops = np.cumsum([len(x) for x in others[first:last]])
            out[first:last] = np.diff(shares[np.concatenate(([0], stops))])
            first = last
        return out

    @staticmethod
    def _pop(queue: list[int], waiting: np.ndarray) -> Iterator[int]:
        while queue:
            x = queue.pop(0)
            if waiting[x]:
                yield x


def _stars(links: list[tuple[int, int]], ids: list[int]) -> dict[int, int]:
    """Each linked id that is not the smallest of its component, with the smallest."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in links:
        a, b = find(ids[i]), find(ids[j])
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root if find(x) != x}


def _verify(tasks: DataFrame, percent: int) -> DataFrame:
    """(u, v): each class that a task links, with the smallest of its component in the task.

    Tasks are rows (_task, _class, n, tokens, _label, _left).
    """

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []

        def done(rows: list) -> Iterator[pa.RecordBatch]:
            if len(rows) < 2:
                return
            ids = [r[0] for r in rows]
            found = Verifier(percent).links(
                [r[2] for r in rows],
                np.array([r[1] for r in rows]),
                np.array([r[3] for r in rows]),
                np.array([r[4] for r in rows]),
            )
            least = _stars(found, ids)
            if least:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(least.keys(), pa.int64()), pa.array(least.values(), pa.int64())], ["u", "v"]
                )

        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                batch = whole.slice(first, 500)
                names = ("_task", "_class", "n", "tokens", "_label", "_left")
                for task, own, n, data, label, left in zip(*(batch.column(c).to_pylist() for c in names)):
                    if task != current and rows:
                        yield from done(rows)
                        rows = []
                    current = task
                    rows.append((own, n, _tokens(data), label, left))
        yield from done(rows)

    parts = shared.shuffle_partitions(tasks.sparkSession)
    spread = tasks.repartition(parts, "_task").sortWithinPartitions("_task")
    return spread.mapInArrow(verify, "u long, v long")


def _with_labels(classes: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    labels = edges.select(F.col("u").alias("_class"), F.col("v").alias("_found"))
    joined = classes.join(labels, "_class", "left")
    return joined.withColumn(name, F.coalesce("_found", "_class")).drop("_found")


def class_links(classes: DataFrame, percent: int, block_tokens: int | None = None) -> DataFrame:
    """(u, v) component edges of classes (_class, n, tokens), stored.

    Candidates share a prefix token under the first order, which puts them into one group. A group
    whose tokens exceed a block is cut into blocks: first each block alone, then one class of every
    component found so far, and last all classes outside the group's largest component against
    every block. Only pairs that are connected already are left out, so no link is lost.
    """
    block_tokens = block_tokens or BLOCK_TOKENS

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, n, data in zip(*(batch.column(c).to_pylist() for c in ("_class", "n", "tokens"))):
                tokens = _tokens(data)
                chosen = _ranked(tokens, 0)[: len(tokens) - _needed(n, percent) + 1]
                ids = pa.array(np.full(len(chosen), own))
                yield pa.RecordBatch.from_arrays([ids, pa.array(chosen.astype(np.int64))], ["u", "t"])

    rows = classes.mapInArrow(prefix, "u long, t long")
    leaders = rows.groupBy("t").agg(F.min("u").alias("v"), F.count(F.lit(1)).alias("_n"))
    near = rows.join(leaders.filter("_n > 1"), "t").select("u", "v").filter("u != v")
    groups = components(near)
    grouped = _with_labels(classes, groups, "_group")
    sizes = grouped.groupBy("_group").agg(
        F.count(F.lit(1)).alias("_count"), F.sum(F.col("n").cast("long")).alias("_size")
    )
    sizes = sizes.filter("_count > 1")
    many = shared.stored(
        grouped.join(sizes, "_group").withColumn("_blocks", F.ceil(F.col("_size") / block_tokens)), "groups"
    )
    block = F.pmod(F.xxhash64("_class"), F.col("_blocks"))
    alone = many.withColumns(
        {"_task": F.struct("_group", block.alias("a"), F.lit(0).alias("b")), "_label": F.col("_class"), "_left": F.lit(True)}
    )
    # A group of one block is a task of its own, so the task's components are final.
    links = shared.stored(_verify(alone, percent), "links")
    large = many.filter("_blocks > 1")
    if large.isEmpty():
        return links
    return _across_blocks(large, links, percent, block_tokens)


def _across_blocks(large: DataFrame, links: DataFrame, percent: int, block_tokens: int) -> DataFrame:
    # One class of each component so far; fewer blocks each time, until all fit or none is left.
    labelled = shared.stored(_with_labels(large, links, "_label"), "blocks")
    heads = labelled.filter("_class = _label")
    sizes = heads.groupBy("_group").agg(F.sum(F.col("n").cast("long")).alias("_size"))
    blocks = F.ceil(F.col("_size") / block_tokens)
    heads = heads.drop("_size").join(sizes, "_group").withColumns(
        {
            "_task": F.struct("_group", F.pmod(F.xxhash64("_class", F.lit(1)), blocks).alias("a"), F.lit(0).alias("b")),
            "_left": F.lit(True),
        }
    )
    links = components(links.unionByName(_verify(heads, percent)))
    labelled = shared.stored(_with_labels(large, links, "_label"), "blocks")
    counts = labelled.groupBy("_group", "_label").agg(F.sum(F.col("n").cast("long")).alias("_own"))
    main = counts.groupBy("_group").agg(F.max_by("_label", F.struct("_own", "_label")).alias("_main"))
    chunks = counts.join(main, "_group").filter("_label != _main")
    chunks = chunks.groupBy("_group", "_main").agg(F.ceil(F.sum("_own") / block_tokens).alias("_chunks"))
    marked = labelled.join(chunks, "_group")
    block = F.pmod(F.xxhash64("_class"), F.col("_blocks"))
    chunk = F.pmod(F.xxhash64("_class", F.lit(2)), F.col("_chunks"))
    outside = F.col("_label") != F.col("_main")
    # Every class meets every chunk of the outside classes; these go to all blocks of the group.
    as_block = marked.withColumns({"_a": block, "_b": F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))})
    as_block = as_block.filter(~outside | (F.col("_b") != chunk)).withColumn("_left", F.lit(False))
    as_chunk = marked.filter(outside).withColumns(
        {"_a": F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)), "_b": chunk, "_left": F.lit(True)}
    )
    tasks = as_block.unionByName(as_chunk).withColumn(
        "_task", F.struct("_group", F.col("_a").alias("a"), F.col("_b").alias("b"))
    )
    return components(links.unionByName(_verify(tasks, percent)))


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    percent: int = 85,
    block_tokens: int | None = None,
) -> DataFrame:
    """(id, n_shingles, component_id) of every row of `docs`.

    A text's set holds its distinct runs of `shingle` words (A-Z lower-cased, parted by space, tab
    and line breaks); a text with fewer words has one run of all. Rows are linked when 100 times
    the intersection is at least `percent` times the union; null, empty and blank texts have no set
    and no links. component_id is the smallest id that links reach. Rows that repeat an id are rows
    of their own; null ids are ignored in the minimum, and a component of null ids only has a null
    id. Other columns of `docs` are ignored; an empty table gives none.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = shared.stored(repeated_tokens(texts, shingle, percent), "token-sets")
    key = F.concat_ws(":", F.hex("d1"), F.hex("d2"))
    rows = found.select("_rid", "_id", "n", F.when(F.col("tokens").isNotNull(), key).alias("_key"))
    classes = shared.stored(
        rows.filter(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.min("_rid").alias("_class"), F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_n")),
        "classes",
    )
    heads = shared.stored(
        found.filter(F.col("tokens").isNotNull())
        .select(F.col("_rid").alias("_class"), "n", "tokens")
        .join(classes.select("_class"), "_class", "left_semi"),
        "class-sets",
    )
    links = class_links(heads, percent, block_tokens)
    labelled = _with_labels(classes, links, "_component")
    least = labelled.groupBy("_component").agg(F.min("_least").alias("component_id"))
    named = shared.stored(
        labelled.join(least, "_component").select("_key", "_n", "component_id"), "components"
    )
    return shared.attach(rows, named, "_key", "_n").select(
        F.col("_id").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "_id").alias("component_id"),
    )


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    **options,
) -> DataFrame:
    """One row of every component of `docs`, with all columns: the one with the smallest id, null
    ids last; of rows that repeat that id any one, but one only.

    The defaults are the rule for stages of a pipeline: five words, similarity 0.8. Rows are told
    apart by a number of their own, so repeated and null ids do not stand for one another. Null, empty and
    blank texts are linked with nothing and stay, as do columns of any name. An empty table gives
    none."""
    row = "_row"
    while row in {c.lower() for c in docs.columns}:
        row = f"_{row}"
    numbered = shared.stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = jaccard_components(
        numbered.select(row, F.col(f"`{text_col}`")), row, text_col, shingle=shingle, percent=percent, **options
    )
    ids = numbered.select(F.col(row).alias("_n"), F.col(f"`{id_col}`").alias("_i"))
    members = found.select(F.col(row).alias("_n"), F.col("component_id").alias("_c")).join(ids, "_n")
    first = F.struct(F.col("_i").isNull(), "_i", "_n")
    # A component of copies may hold a third of all rows; the minimum is found before the shuffle.
    kept = members.groupBy("_c").agg(F.min(first)["_n"].alias(row)).select(row)
    return numbered.join(kept, row, "left_semi").select([F.col(f"`{c}`") for c in docs.columns])
