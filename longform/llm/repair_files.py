"""Token ids in files of Re-Pair blocks, with random access.

``write_token_files`` sends documents to shards by range of ``doc_id``, so shards, blocks
and documents stand in ascending order. Inside a shard ids are gathered into blocks of about
``block_ids`` ids (whole documents), so that memory is bounded, and each block has a grammar of its
own. It is compressed by Re-Pair until no pair of neighbouring symbols occurs ``MIN_COUNT`` times.
A round replaces many pairs at once, the more frequent before those they overlap; what is left of
these waits for the next round.

A file is a Parquet dataset with one row per block: ``shard``, ``seq``, ``n_docs``, ``n_ids``
and ``block``, the bytes below (little-endian), which need no other row to be decoded. Spark's
committer makes the write atomic: a lost executor repeats its tasks, and nothing is written
beside them.

    4 bytes   magic ``RPG1``
    6 x u32   first nonterminal, rules, symbols, bytes a symbol (2 or 4), documents, 0
    i64 x d   doc_id of each document (the smallest i64 stands for null)
    u64 x d   ids up to the end of each document
    u32 x 2r  the two symbols of each rule
    u32 x r   expansion length of each rule
    symbols   the compressed ids

A rule only uses ids and earlier rules. Expansion lengths turn an id position into a symbol
position by one running sum, so ``read_ids`` expands only the symbols that cover a range.

Null and empty texts are documents with only the end id. Null doc_ids come first; repeated
doc_ids stand side by side, ordered by text. An empty table gives an empty file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from longform.llm.shipping import ship
from longform.llm.word_tokens import encoder
from longform.llm.workers import enter

MAGIC = b"RPG1"
NO_ID = -(2**63)
BLOCK_IDS = 1_000_000
#: A pair must occur this often in a block to get a rule, which takes 12 bytes and saves 2 or 4 a use.
MIN_COUNT = 12
#: The top 17 bits of a pair's hash.
BUCKETS = 1 << 17
BLOCK_SCHEMA = "shard int, seq int, n_docs long, n_ids long, block binary"


def bucket_of(keys):
    import numpy as np

    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(47)).astype(np.int32)


def frequent_pairs(keys, bucket, least: int):
    """The keys that occur at least ``least`` times, ascending, each one's rank by count (equal counts by key), and where each
    key stands among them (-1: nowhere). ``bucket`` is each key's; keys that share one are searched for, there are few.
    """
    import numpy as np

    ordered = np.sort(keys)
    edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
    count = np.diff(edge, append=len(ordered))
    pairs, count = ordered[edge[count >= least]], count[count >= least]
    if not len(pairs):
        return pairs, count, np.full(len(keys), -1, np.int32)
    of = bucket_of(pairs)
    table = np.full(BUCKETS, -1, np.int32)
    table[of] = np.arange(len(pairs), dtype=np.int32)
    place = table[bucket]
    miss = pairs[place] != keys
    place[miss] = -1
    again = np.flatnonzero(miss & (np.bincount(of, minlength=BUCKETS) > 1)[bucket])
    near = np.minimum(np.searchsorted(pairs, keys[again]), len(pairs) - 1)
    place[again] = np.where(pairs[near] == keys[again], near, -1)
    rank = np.empty(len(pairs), np.int32)
    rank[np.argsort(count, kind="stable")] = np.arange(len(pairs), dtype=np.int32)
    return pairs, rank, place


def first_choices(at, after, rank):
    """Of pairs that start at ``at`` (ascending; ``after``: where their right symbols are), those to replace.

    A pair is chosen if its ``rank`` is above those it overlaps; of a run of one pair that overlaps itself every second is, from
    the left. Pairs that overlap none of these have their turn next, until each is chosen or overlaps a chosen one. As the choice
    depends on the symbols around and not on places, copies are replaced alike.
    """
    import numpy as np

    joined = np.zeros(len(at) + 1, bool)
    np.equal(after[:-1], at[1:], out=joined[1:-1])
    chosen, busy, left = [], np.zeros(len(at) + 2, bool), np.arange(len(at), dtype=np.int32)
    while len(left):
        high = rank[left]
        step = np.diff(high)
        beside = joined[left[1:]]
        beside &= np.diff(left) == 1
        wins = np.ones(len(left), bool)
        wins[1:] &= ~(beside & (step < 0))
        wins[:-1] &= ~(beside & (step > 0))
        beside &= step == 0
        if beside.any():
            begin = np.flatnonzero(beside & ~np.concatenate([[False], beside[:-1]]))
            size = np.flatnonzero(beside & ~np.concatenate([beside[1:], [False]])) + 2 - begin
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            whole = np.repeat(wins[begin] & wins[begin + size - 1], size)
            wins[np.repeat(begin, size) + inside] = whole & (inside % 2 == 0)
        new = left[wins]
        chosen.append(new)
        # busy is shifted by one, so that the first and the last pair have neighbours
        busy[new + 1] = True
        busy[new] |= joined[new]
        busy[new + 2] |= joined[new + 1]
        left = left[~busy[left + 1]]
    return np.sort(np.concatenate(chosen))


def compress(ids, first: int, least: int = MIN_COUNT):
    """(symbols, rules as an r x 2 array) of some ids below ``first``; no pair is left that occurs ``least`` times.

    Symbols are a linked list, and a round looks only at pairs that may be frequent: those found frequent
    before, and those that hold a symbol of the last round. All others can only have become rarer.
    """
    import numpy as np

    n, top, rules = len(ids), first, []
    symbols, alive = ids.astype(np.uint32), np.ones(n, bool)
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    at, right = np.arange(max(n - 1, 0), dtype=np.int32), after[:-1]
    while True:
        keys = symbols[at].astype(np.uint64)
        keys <<= np.uint64(32)
        keys |= symbols[right]
        bucket = bucket_of(keys)
        likely = np.flatnonzero((np.bincount(bucket, minlength=BUCKETS) >= least)[bucket])
        pairs, rank, place = frequent_pairs(keys[likely], bucket[likely], least)
        if not len(pairs):
            break
        found = np.flatnonzero(place >= 0)
        place, found = place[found], likely[found]
        at, right = at[found], right[found]
        chosen = first_choices(at, right, rank[place])
        # pairs may lose places to others; the most frequent loses them only to itself and keeps half, so each round replaces some
        pays = np.bincount(place[chosen], minlength=len(pairs)) >= least // 2
        chosen = chosen[pays[place[chosen]]]
        rules.append(np.stack([pairs[pays] >> np.uint64(32), pairs[pays] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        new, gone = at[chosen], right[chosen]
        symbols[new] = (top + np.cumsum(pays) - 1).astype(np.uint32)[place[chosen]]
        top += len(rules[-1])
        beyond = after[gone]
        after[new], before[beyond], alive[gone] = beyond, new, False
        held, left = np.zeros(n, bool), before[new]
        held[at] = held[left[left >= 0]] = True
        held[gone] = False
        at = np.flatnonzero(held).astype(np.int32)
        right = after[at]
        if len(at) and right[-1] == n:
            at, right = at[:-1], right[:-1]
    return symbols[alive], np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def expansion_lengths(rules, first: int):
    """Ids that each rule stands for."""
    import numpy as np

    lengths: list[int] = []
    for left, right in rules.tolist():
        lengths.append((lengths[left - first] if left >= first else 1) + (lengths[right - first] if right >= first else 1))
    return np.asarray(lengths, np.uint32)


def open_rules(symbols, rules, first: int):
    """The ids of some symbols, one level of nonterminals after the other."""
    import numpy as np

    while len(symbols) and (inner := symbols >= first).any():
        size = 1 + inner.astype(np.int64)
        to = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.uint32)
        out[to[~inner]] = symbols[~inner]
        pair = rules[symbols[inner] - first]
        out[to[inner]], out[to[inner] + 1] = pair[:, 0], pair[:, 1]
        symbols = out
    return symbols


def expand(symbols, rules, first: int, lengths=None):
    """The ids of some symbols: each different nonterminal among them is opened once, then copied to its places."""
    import numpy as np

    if not len(rules) or not len(symbols):
        return symbols
    lengths = expansion_lengths(rules, first) if lengths is None else lengths
    inner = symbols >= first
    rule = symbols[inner] - first
    seen = np.zeros(len(rules), bool)
    seen[rule] = True
    names = np.flatnonzero(seen)
    flat = open_rules((names + first).astype(np.uint32), rules, first)
    begin = np.zeros(len(rules), np.int64)
    begin[names] = np.cumsum(lengths[names], dtype=np.int64) - lengths[names]
    # plain ids follow the opened rules, so that one gather fills the result
    size, source = np.ones(len(symbols), np.int64), np.empty(len(symbols), np.int64)
    size[inner], source[inner] = lengths[rule], begin[rule]
    source[~inner] = len(flat) + np.arange(len(symbols) - len(rule))
    source -= np.cumsum(size) - size
    everything = np.concatenate([flat, symbols[~inner]])
    return everything[np.repeat(source, size) + np.arange(int(size.sum()))]


def pack(doc_ids, ends, ids, first: int) -> bytes:
    """One block."""
    import numpy as np

    symbols, rules = compress(ids, first)
    width = 2 if first + len(rules) <= 1 << 16 else 4
    head = struct.pack("<4s6I", MAGIC, first, len(rules), len(symbols), width, len(doc_ids), 0)
    parts = [np.asarray(doc_ids, "<i8"), np.asarray(ends, "<u8"), rules.astype("<u4"), expansion_lengths(rules, first).astype("<u4")]
    return head + b"".join(p.tobytes() for p in parts) + symbols.astype(f"<u{width}").tobytes()


class Block:
    """A block's tables, and its ids from ``start`` to ``stop``."""

    def __init__(self, data: bytes):
        import numpy as np

        magic, self.first, r, n, width, d, _ = struct.unpack_from("<4s6I", data)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        at = 28
        self.doc_ids, at = np.frombuffer(data, "<i8", d, at), at + 8 * d
        self.ends, at = np.frombuffer(data, "<u8", d, at).astype(np.int64), at + 8 * d
        self.rules, at = np.frombuffer(data, "<u4", 2 * r, at).reshape(r, 2), at + 8 * r
        self.lengths, at = np.frombuffer(data, "<u4", r, at), at + 4 * r
        self.symbols = np.frombuffer(data, f"<u{width}", n, at).astype(np.uint32)
        size = np.ones(n, np.int64)
        inner = self.symbols >= self.first
        size[inner] = self.lengths[self.symbols[inner] - self.first]
        self.upto = np.cumsum(size)

    def read_ids(self, start: int, stop: int):
        """Ids of positions start (inclusive) to stop (exclusive); only the symbols that cover them are expanded."""
        import numpy as np

        if stop <= start:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(self.upto, [start, stop - 1], side="right")
        before = int(self.upto[a - 1]) if a else 0
        return expand(self.symbols[a : b + 1], self.rules, self.first, self.lengths)[start - before : stop - before]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, first: int | None = None, block_ids: int = BLOCK_IDS) -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending doc_id order.

    ``first`` is the first nonterminal, above all ids; by default the first number that the tokenizer does not use.
    """
    first = max(encoder(tokenizer).n_ids, end_id + 1) if first is None else first

    def blocks(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        enter("word_tokens", encoder(tokenizer).forget)
        shard, end = TaskContext.get().partitionId(), np.asarray([end_id], np.uint32)
        seq, names, parts, ends, held = 0, [], [], [], 0

        def row():
            ids = np.concatenate(parts)
            if int(ids.max()) >= first:
                raise ValueError(f"id {int(ids.max())} is not below the first nonterminal {first}")
            data = pack(names, ends, ids, first)
            return pd.DataFrame({"shard": [shard], "seq": [seq], "n_docs": [len(ends)], "n_ids": [held], "block": [data]})

        for batch in batches:
            for name, ids in zip(batch["doc_id"], encoder(tokenizer).encode_each(batch["text"].tolist()), strict=True):
                names.append(NO_ID if pd.isna(name) else int(name))
                parts += [ids, end]
                held += len(ids) + 1
                ends.append(held)
                if held >= block_ids:
                    yield row()
                    seq, names, parts, ends, held = seq + 1, [], [], [], 0
        if parts:
            yield row()

    spark = docs.sparkSession
    ship(spark)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(shards, "doc_id")
    ordered = dealt.sortWithinPartitions("doc_id", "text")
    ordered.mapInPandas(blocks, BLOCK_SCHEMA).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


def block_offsets(blocks: DataFrame) -> DataFrame:
    """shard, seq, before: ids of all earlier blocks. One row per shard meets in a task, then one per block of a shard."""
    narrow = blocks.select("shard", "seq", "n_ids")
    shards = narrow.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    up = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("_ids").over(up), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return narrow.join(shards, "shard").select(
        "shard", "seq", (F.col("_before") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("before")
    )


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ``ids`` if asked, from the files."""
    fields = "doc_id long, shard int, seq int, _at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def documents(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pandas as pd

        for batch in batches:
            for shard, seq, data in zip(batch["shard"], batch["seq"], batch["block"], strict=True):
                block = Block(data)
                starts = np.concatenate([[0], block.ends[:-1]])
                ids = block.read_ids(0, int(block.ends[-1])).astype("<u4")
                each = [ids[a:b] for a, b in zip(starts, block.ends, strict=True)]
                out = {
                    "doc_id": pd.array(np.where(block.doc_ids == NO_ID, 0, block.doc_ids), dtype="Int64"),
                    "shard": shard,
                    "seq": seq,
                    "_at": starts,
                    "n_tokens": block.ends - starts,
                    "ids_crc32": [zlib.crc32(x.tobytes()) for x in each],
                }
                out["doc_id"][block.doc_ids == NO_ID] = pd.NA
                yield pd.DataFrame(out | ({"ids": [x.astype(np.int64) for x in each]} if with_ids else {}))

    ship(spark)
    blocks = read_blocks(spark, path)
    docs = blocks.select("shard", "seq", "block").mapInPandas(documents, fields)
    placed = docs.join(block_offsets(blocks), ["shard", "seq"])
    columns = ["doc_id", (F.col("before") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32"]
    return placed.select(*columns, *["ids"] * with_ids)
