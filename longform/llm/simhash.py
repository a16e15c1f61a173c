"""SimHash near-duplicates by pigeonring filtering.

A text's fingerprint has a bit set where over half of its shingles' XXH64 hashes have it (three words, A-Z
in lower case, repeats counted). Fingerprints that differ in at most two bits are linked, links join into components.

Texts with one fingerprint are one node. The bits are laid out as a ring of four segments. If two
fingerprints differ in at most ``DISTANCE`` = 2 bits, there is a segment from which on every chain of
l consecutive segments has at most l * 2 / 4 differences: none in the first, at most one in the first two, at most
one in the first three, two in all (were there no such start, the ring's sum would exceed 2). So the first segment
agrees, and with it the second, or the second differs in one bit and the third agrees. Hence two segments agree in
any case: fingerprints meet under the values of each two of the four. A pair that meets is first held to the budgets
of the chain that brought it there, and only then compared in all bits.

A bucket of more than ``BLOCK`` fingerprints is not compared: its fingerprints agree in half of the bits, and the ring
is laid out anew over the other half. After three rings 8 bits are left, so no bucket can have more than 256; nothing is
capped, and no bucket is collected that could be large. A bucket returns a star for each of its components, not its pairs.

A text without words (null, empty or blank) has fingerprint zero and is linked like any other; with fewer words than
three the whole sequence is the one shingle. Rows without a doc_id take part, and count for no component's id (null if no
row of the component has one). Repeated rows repeat their results. An empty table gives an empty
result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from longform.llm.components import components
from longform.llm.shipping import ship
from longform.llm.text import ascii_words
from longform.llm.workers import enter
from longform.sources.storage import settle, store

WIDTH = 3
SEED = 42
DISTANCE = 2
SEGMENTS = 4
RINGS = 3
#: Fingerprints of a bucket that are compared in one place.
BLOCK = 512
#: Tasks that share a key when its fingerprints are told its size.
SALTS = 16
#: Hashes whose bits are counted at a time.
HASHES_AT_ONCE = 1 << 14


# -- fingerprints -------------------------------------------------------------------


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of each run of three words, or of all words if there are fewer."""
    from xxhash import xxh64_intdigest

    if not words:
        return np.zeros(0, np.uint64)
    text = b" ".join(words)
    if len(words) <= WIDTH:
        return np.array([xxh64_intdigest(text, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    runs = zip(starts[: 1 - WIDTH].tolist(), ends[WIDTH - 1 :].tolist(), strict=True)
    return np.fromiter((xxh64_intdigest(text[a:b], SEED) for a, b in runs), np.uint64, len(words) - WIDTH + 1)


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint, unsigned."""
    hashes = shingle_hashes(ascii_words(text))
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), HASHES_AT_ONCE):
        rows = hashes[a : a + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (its 64 bits as a long) of every row."""
    ship(docs.sparkSession)

    def sign(batches: Iterator) -> Iterator:
        import pandas as pd

        enter("simhash")
        for batch in batches:
            prints = np.array([fingerprint(t) for t in batch["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fingerprint": prints})

    source = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return source.mapInPandas(sign, "doc_id string, fingerprint long").select(F.col("doc_id").cast("long").alias("doc_id"), "fingerprint")


# -- rings of segments --------------------------------------------------------------


@dataclass(frozen=True)
class Meeting:
    """Two segments that agree: ``mask`` has all bits agreed so far, ``rest`` the others, in order.

    ``chains``: for each start that leads here, the bits of the chain's first three segments and the differences they may have.
    """

    mask: int
    rest: tuple[int, ...]
    chains: tuple[tuple[int, int], ...]


def _bits(places) -> int:
    return sum(1 << p for p in places)


def meetings(agreed: int, rest: tuple[int, ...]) -> list[Meeting]:
    """The ring over the bits ``rest``: every two of its segments, with the chains that need those two to agree."""
    size = len(rest) // SEGMENTS
    part = [rest[k * size : (k + 1) * size] for k in range(SEGMENTS)]
    chains: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for start in range(SEGMENTS):
        second, third = (start + 1) % SEGMENTS, (start + 2) % SEGMENTS
        first_three = (_bits(part[start] + part[second] + part[third]), 3 * DISTANCE // SEGMENTS)
        for other in (second, third):
            chains.setdefault((min(start, other), max(start, other)), []).append(first_three)
    out = []
    for two, found in sorted(chains.items()):
        left = tuple(p for k in range(SEGMENTS) if k not in two for p in part[k])
        out.append(Meeting(agreed | _bits(part[two[0]] + part[two[1]]), left, tuple(found)))
    return out


def rings(depth: int = RINGS) -> list[list[Meeting]]:
    """All meetings after one ring, two rings, ...; those that follow from meeting i stand at 6 i to 6 i + 5."""
    levels = [meetings(0, tuple(range(64)))]
    while len(levels) < depth:
        levels.append([n for m in levels[-1] for n in meetings(m.mask, m.rest)])
    return levels


def close(different: np.ndarray, chains: tuple[tuple[int, int], ...]) -> np.ndarray:
    """Which differences keep within a chain's budgets and then within the distance in all bits."""
    viable = np.zeros(different.shape, bool)
    for bits, budget in chains:
        viable |= np.bitwise_count(different & np.uint64(bits)) <= budget
    viable[viable] = np.bitwise_count(different[viable]) <= DISTANCE
    return viable


def stars(prints: np.ndarray, chains: tuple[tuple[int, int], ...]) -> list[tuple[int, int]]:
    """The components among the fingerprints of a bucket, each as links from its first member to all others."""
    near = close(prints[:, None] ^ prints[None, :], chains)
    out, open_ = [], np.ones(len(prints), bool)
    for first in range(len(prints)):
        if open_[first]:
            edge = reached = np.arange(len(prints)) == first
            while edge.any():
                edge = near[edge].any(0) & ~reached
                reached = reached | edge
            open_ &= ~reached
            out += [(first, k) for k in np.flatnonzero(reached) if k != first]
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bucket_links(buckets: DataFrame, ring: list[Meeting]) -> DataFrame:
    """(u, v) links that join what is near in each bucket (path, prints)."""
    chains = [m.chains for m in ring]

    def compare(batches: Iterator) -> Iterator:
        import pandas as pd

        enter("simhash")
        for batch in batches:
            found = []
            sizes = batch["prints"].map(len).to_numpy()
            paths = batch["path"].to_numpy()
            pairs = batch[sizes == 2]
            for path in np.unique(paths[sizes == 2]).tolist():  # most buckets are pairs, held against each other at once
                two = np.stack(pairs["prints"][pairs["path"] == path].to_list()).astype(np.int64).view(np.uint64)
                found.append(two[close(two[:, 0] ^ two[:, 1], chains[path])])
            for path, prints in zip(paths[sizes > 2].tolist(), batch["prints"][sizes > 2], strict=True):
                each = np.asarray(prints, np.int64).view(np.uint64)
                links = stars(each, chains[path])
                if links:
                    found.append(each[np.array(links)])
            if found:
                yield pd.DataFrame(np.concatenate(found).view(np.int64), columns=["u", "v"])

    return buckets.mapInPandas(compare, "u long, v long")


def _of_size(met: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of ``met`` whose key is among ``sizes``; a hot key's rows are dealt to several tasks."""
    salted = met.withColumn("salt", F.pmod(F.xxhash64("fingerprint"), F.lit(SALTS)))
    repeated = sizes.select("path", "key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return salted.join(repeated.withColumn("salt", F.col("salt").cast("long")), ["path", "key", "salt"]).drop("salt")


def near_links(prints: DataFrame) -> DataFrame:
    """Links (u, v) that join all fingerprints within the distance, given distinct ``fingerprint``s."""
    links, members = None, prints.select("fingerprint", F.lit(0).alias("path"))
    for level, ring in enumerate(rings()):
        masks = [F.lit(_signed(m.mask)) for m in ring]
        options = F.array(*[F.array(*masks[k : k + 6]) for k in range(0, len(masks), 6)])
        met = members.select("fingerprint", "path", F.posexplode(F.element_at(options, F.col("path") + 1)).alias("option", "mask"))
        met = met.select("fingerprint", (F.col("path") * 6 + F.col("option")).alias("path"), F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"))
        sizes = settle(met.groupBy("path", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-buckets", most=F.max("n"))
        most = sizes.metrics["most"] or 0
        last = level == RINGS - 1
        few = sizes.df if last else sizes.df.where(F.col("n") <= BLOCK)
        buckets = _of_size(met, few).groupBy("path", "key").agg(F.collect_list("fingerprint").alias("prints"))
        found = bucket_links(buckets.select("path", "prints"), ring)
        links = found if links is None else links.unionByName(found)
        if last or most <= BLOCK:
            break
        members = store(_of_size(met, sizes.df.where(F.col("n") > BLOCK)).select("fingerprint", "path"), "simhash-members")
    return links.distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    prints = store(fingerprints(docs), "fingerprints")
    classes = store(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    roots = components(near_links(classes))
    rooted = classes.join(roots, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    # a fingerprint that a third of all rows share is a skewed key of the many-to-one join below, which adaptive execution splits
    named = store(rooted.join(least, "root").select("fingerprint", "component_id"), "fingerprint-components")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return prints.join(named, "fingerprint").select("doc_id", digits.alias("fingerprint"), "component_id")
