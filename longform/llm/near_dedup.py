"""MinHash near-duplicates with sequential Bayesian verification.

1. Every text becomes its set of five-word shingles, named by a 128-bit digest. Texts with
   the same set form a class, whose smallest doc_id stands for it from here on; a group of
   thousands of copies is one node.
2. Signatures of ``HASHES`` minima are cut into bands; classes that share a band are in a bucket.
3. Pairs of a bucket are verified in order: signatures are compared batch by batch, and a pair
   is given up as soon as the posterior probability that its similarity reaches the threshold
   (uniform prior, binomial likelihood of the agreeing minima) falls below ``MISS``. Survivors
   are decided on their full shingle sets.
4. Links join into components. Only links that matter to them are looked for: ``HUB_ROUNDS``
   times, each bucket compares one member with all members of other components; the hub then
   has no open pair left in that bucket and leaves it. Pairs still open after that
   (members in different components) are all compared in blocks of a bucket, several tasks
   to a large bucket, and only survivors leave a task.

A link at the threshold is missed with probability ``(1 - t**rows)**bands`` (no common band,
below ``BAND_MISS`` by the choice of rows) or about ``MISS`` a batch; nothing is capped.

Null, empty and blank texts have no shingles and are linked with nothing. Rows that share a
doc_id are one document: its texts are linked. Rows without a doc_id are linked with nothing
and kept. Repeated rows give repeated results. Empty tables give empty results. Only
``doc_id`` and ``text`` are read, except by ``drop_near_duplicates``, which keeps all columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from longform.llm.components import components
from longform.llm.shipping import ship
from longform.llm.workers import enter
from longform.sources.storage import join_small, settle, store

HASHES = 128
BATCH = 32
BAND_MISS = 1e-6
MISS = 1e-6
HUB_ROUNDS = 1
#: Members of a bucket, and shingles of theirs, that make a block in the last step.
BLOCK = 512
BLOCK_SHINGLES = 2_000_000
SIGNATURE = "doc_id long, n_shingles long, name binary, sig binary"


def band_rows(percent: int, hashes: int = HASHES) -> int:
    """The most rows a band can have while a pair at the threshold shares a band with probability 1 - BAND_MISS."""
    t = percent / 100
    return max(r for r in range(1, 17) if r == 1 or (1 - t**r) ** (hashes // r) <= BAND_MISS)


def least_matches(percent: int, n: int, miss: float = MISS) -> int:
    """Fewest agreeing minima of n at which similarity >= percent / 100 is still credible.

    With a uniform prior, P(s >= t | m of n) = P(Binomial(n + 1, t) <= m).
    """
    t, total = percent / 100, 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def signature_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, and the digest and signature of the shingle set (null without shingles)."""
    ship(docs.sparkSession)

    def sign(batches: Iterator) -> Iterator:
        import pandas as pd

        from longform.llm.shingles import digest, shingle_sets, signatures

        enter("near_dedup")
        for batch in batches:
            sets = shingle_sets(batch["text"].tolist())
            full = [i for i, s in enumerate(sets) if len(s)]
            rows = signatures([sets[i] for i in full], HASHES)
            names, sigs = [None] * len(sets), [None] * len(sets)
            for i, row in zip(full, rows, strict=True):
                names[i], sigs[i] = digest(sets[i]), row.astype("<u4").tobytes()
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_shingles": [len(s) for s in sets], "name": names, "sig": sigs})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL").mapInPandas(sign, SIGNATURE)


def agreeing(a, b, percent: int):
    """Rows of two signature matrices that survive the sequential test."""
    import numpy as np

    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for start in range(0, a.shape[1], BATCH):
        stop = min(start + BATCH, a.shape[1])
        matches = matches + (a[alive, start:stop] == b[alive, start:stop]).sum(axis=1)
        good = matches >= least_matches(percent, stop)
        alive, matches = alive[good], matches[good]
    return alive


def _matrix(column):
    import numpy as np

    return np.frombuffer(b"".join(column), "<u4").reshape(len(column), -1)


def credible_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that pass the sequential test on their signatures."""
    side = lambda name: classes.select(F.col("node").alias(name), F.col("sig").alias(f"sig_{name}"))

    def verify(batches: Iterator) -> Iterator:
        for batch in batches:
            if len(batch):
                alive = agreeing(_matrix(batch["sig_a"]), _matrix(batch["sig_b"]), percent)
                yield batch.iloc[alive][["a", "b"]]

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(verify, "a long, b long")


def shingle_table(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, shingles) of some doc_ids: only their texts are read again."""
    wanted = settle(nodes.select(F.col("node").alias("doc_id")).distinct(), "wanted-ids")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def sets(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        from longform.llm.shingles import shingle_sets

        enter("near_dedup")
        for batch in batches:
            each = [s.astype("<u8").tobytes() for s in shingle_sets(batch["text"].tolist())]
            yield pd.DataFrame({"node": batch["doc_id"].astype(np.int64), "shingles": each})

    full = join_small(texts, wanted.df, ["doc_id"], "inner", fits=wanted.fits).mapInPandas(sets, "node long, shingles binary")
    return store(full.where("length(shingles) > 0"), "shingle-sets")


def reaches(x, others: list, percent: int):
    """For one sorted set and several: whether their similarity is percent / 100 or more."""
    import numpy as np

    sizes = np.array([len(y) for y in others])
    flat = np.concatenate(others)
    hit = x[np.minimum(np.searchsorted(x, flat), len(x) - 1)] == flat
    both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * both >= percent * (len(x) + sizes - both)


def exact_links(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""
    full = shingle_table(pairs.select(F.explode(F.array("a", "b")).alias("node")), docs)
    side = lambda name: full.select(F.col("node").alias(name), F.col("shingles").alias(f"set_{name}"))

    def decide(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            sets = [(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")) for x, y in zip(batch["set_a"], batch["set_b"], strict=True)]
            yield batch[[bool(reaches(x, [y], percent)[0]) for x, y in sets]][["a", "b"]]

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(decide, "a long, b long").distinct()


def hub_pairs(buckets: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """(pairs of a hub with each member of its bucket in another component, buckets without their hubs)."""
    hubs = buckets.groupBy("bucket", "band").agg(
        F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "root")).alias("hub"),
        F.min("root").alias("low"),
        F.max("root").alias("high"),
    )
    open_ = buckets.join(hubs.where("low < high").select("bucket", "band", "hub"), ["bucket", "band"]).where(F.col("node") != F.col("hub.node"))
    ordered = [F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")]
    pairs = open_.where(F.col("root") != F.col("hub.root")).select(*ordered).distinct()
    return pairs, open_.select("bucket", "band", "node", "root")


def block_links(buckets: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, rows: int) -> DataFrame:
    """Links that join the components still apart within a bucket, found block by block.

    A task gets two blocks of a bucket with signatures and full sets. It compares each pair once (in
    the first band that the pair shares), only between members that it has not joined yet, and returns
    only links that join: fewer than its members, however many pairs there are.
    """
    sizes = buckets.join(classes.select("node", "n_shingles"), "node").groupBy("bucket", "band").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("held"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("held") / BLOCK_SHINGLES)).cast("int")
    sizes = store(sizes.where("low < high").select("bucket", "band", blocks.alias("blocks")), "open-buckets")
    dealt = buckets.join(sizes, ["bucket", "band"]).withColumn("block", F.pmod(F.xxhash64("node", F.lit(77)), F.col("blocks")).cast("int"))
    dealt = store(dealt, "open-members")
    full = shingle_table(dealt.select("node"), docs)
    # block i meets every block j; the pair of blocks is named by the smaller and the larger
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("bucket", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "root", "block")
    signed = met.join(classes.select("node", "sig"), "node").join(full, "node")

    def compare(group):
        import numpy as np
        import pandas as pd

        i, j, band = group["i"].iloc[0], group["j"].iloc[0], int(group["band"].iloc[0])
        nodes, blocks, roots = group["node"].to_numpy(), group["block"].to_numpy(), group["root"].to_numpy().copy()
        sigs, sets = _matrix(group["sig"]), [np.frombuffer(x, "<u8") for x in group["shingles"]]
        order = np.argsort(nodes, kind="stable")
        out = []
        for x in order[blocks[order] == i]:
            later = nodes > nodes[x] if i == j else nodes != nodes[x]
            rest = np.flatnonzero((blocks == j) & later & (roots != roots[x]))
            rest = rest[agreeing(np.broadcast_to(sigs[x], (len(rest), sigs.shape[1])), sigs[rest], percent)]
            if band and len(rest):
                before = (sigs[rest, : band * rows] == sigs[x, : band * rows]).reshape(len(rest), band, rows).all(2).any(1)
                rest = rest[~before]
            if len(rest):
                for y in rest[reaches(sets[x], [sets[k] for k in rest], percent)]:
                    if roots[y] != roots[x]:
                        out.append((min(nodes[x], nodes[y]), max(nodes[x], nodes[y])))
                        roots[roots == roots[y]] = roots[x]
        return pd.DataFrame(out, columns=["a", "b"]).astype(np.int64)

    return signed.groupBy("bucket", "band", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def _with_roots(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    named = buckets.drop("root").join(roots, "node", "left")
    return named.select("bucket", "band", "node", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; linked are documents of similarity >= percent / 100."""
    signed = store(signature_table(docs), "signatures")
    classes = (
        signed.where("name IS NOT NULL")
        .groupBy("name")
        .agg(F.min("doc_id").alias("node"), F.min("sig").alias("sig"), F.min("n_shingles").alias("n_shingles"), F.count("*").alias("copies"))
    )
    classes = store(classes, "classes")
    rows = band_rows(percent)
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(HASHES // rows - 1)),
        lambda b: F.xxhash64(b, F.substring("sig", b * 4 * rows + 1, F.lit(4 * rows))),
    )
    banded = classes.select("node", F.posexplode(bands).alias("band", "bucket"))
    shared = banded.groupBy("bucket", "band").agg(F.count("*").alias("n")).where("n > 1").select("bucket", "band")
    members = banded.join(shared, ["bucket", "band"]).select("bucket", "band", "node", F.col("node").alias("root"))
    at = settle(members, "buckets", n=F.count("*"))

    # texts of one doc_id belong together, whatever their classes
    repeated = classes.where("copies > 1").select("name", "node")
    named = signed.where("name IS NOT NULL").select("doc_id", "name").join(repeated, "name", "left")
    named = named.select("doc_id", F.coalesce("node", "doc_id").alias("node"))
    same = named.groupBy("doc_id").agg(F.min("node").alias("u"), F.max("node").alias("v")).where("u < v").select("u", "v")
    links = store(same, "links-found")
    roots = components(links)

    for turn in range(HUB_ROUNDS + 1):
        if not at.metrics["n"]:
            break
        buckets = _with_roots(at.df, roots)
        if turn < HUB_ROUNDS:
            pairs, rest = hub_pairs(buckets, turn)
            at = settle(rest, "buckets", n=F.count("*"))
            found = settle(credible_pairs(pairs, classes, percent), "credible", n=F.count("*"))
            new = exact_links(found.df, docs, percent) if found.metrics["n"] else None
        else:
            new = block_links(buckets, classes, docs, percent, rows)
        if new is not None:
            links = store(links.unionByName(new.toDF("u", "v")), "links-found")
            roots = components(links)

    result = signed.select("doc_id", "n_shingles", "name").join(repeated.withColumnRenamed("node", "first"), "name", "left")
    result = result.select("doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("node")).join(roots, "node", "left")
    component = F.coalesce("root", "node")
    kept = result.select("doc_id", "n_shingles", component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))
    nameless = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NULL")
    alone = nameless.mapInPandas(_counts, "doc_id long, n_shingles long")
    return kept.unionByName(alone.select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")))


def _counts(batches: Iterator) -> Iterator:
    import pandas as pd

    from longform.llm.shingles import shingle_sets

    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "n_shingles": [len(s) for s in shingle_sets(batch["text"].tolist())]})


def drop_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents, with all columns, of which one stays for each component: that of its smallest doc_id.

    Rows that repeat that doc_id collapse to one row (the one with the smallest text); rows without a doc_id stay.
    """
    gone = near_duplicates(docs, percent).where("NOT kept").select("doc_id").distinct()
    out = settle(gone, "dropped")
    left = join_small(docs, out.df, ["doc_id"], "left_anti", fits=out.fits)
    again = settle(left.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated", n=F.count("*"))
    if not again.metrics["n"]:
        return left
    once = left.join(again.df, "doc_id", "left_anti")
    one = left.join(again.df, "doc_id", "left_semi")
    row = F.struct(*one.columns)  # may hold maps, which have no order: rows of one text are told by their JSON
    one = one.groupBy("doc_id").agg(F.min_by(row, F.struct(F.col("text"), F.to_json(row))).alias("row")).select("row.*")
    return once.unionByName(one.select(*once.columns))
