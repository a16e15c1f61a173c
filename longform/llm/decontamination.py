"""Benchmark decontamination by templates, in built-in functions only.

Texts are cut into words and every word gets a template form: numbers, units after a number
and names (words with a capital first letter and a small second one; a run of names is one) become typed placeholders, all else is in
lower case without punctuation. Windows of ``WINDOW`` template words of the benchmark and of
every text meet in a hash join, so a question that only differs in its numbers, units or
names still matches. The benchmark's side has each item a second time in lower case, without names: texts in small letters or in
capitals have none either, so copies in another case meet that form. A match is then read again: along one alignment of a document and an
item, each value of a slot in the item must stand for one value in the document. An alignment with
contradictory slots is split: a stretch of windows counts by itself if its own slots agree, and the whole counts
if it holds at least ``MIN_LITERAL`` literal words for each contradiction. What counts is verbatim (no slot differs) or
re-parameterised; the rest is chance or another question.

A document is contaminated by an item if ``MIN_RUN`` windows of one alignment match (all
windows of an item that has fewer) and count as above. Windows with fewer than ``MIN_LITERAL``
words that are no placeholders say too little and are left out of the benchmark's table; an
item that has none but these is compared by its windows all the same.

Work is keyed by the digest of the text, so copies are judged once. The benchmark's table is
broadcast only if it is measured to fit, otherwise both sides are shuffled by window.
Null and empty texts and items match nothing. An item without an id is searched like any other, and found under a null id;
different texts under one id are different items, of which the best match counts. An item shorter than a window is one
window of its own length. Repeated rows give repeated results; empty tables give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from longform.sources.storage import join_small, settle, store

WINDOW = 8
MIN_LITERAL = 4
MIN_RUN = 5
NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"
#: Words that are units when they follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl l gal s sec secs second seconds min mins minute minutes h hr hrs hour hours "
    "day days week weeks month months year years cent cents dollar dollars usd eur euro euros pound pounds percent degree degrees "
    "meter meters metre metres centimeter centimeters kilometer kilometers mile miles inch inches foot feet yard yards gram grams "
    "kilogram kilograms ounce ounces liter liters litre litres gallon gallons mph kmh w kw v hz khz mhz ghz b kb mb gb tb"
).split()


def _clean(text: Column) -> Column:
    """Words by single blanks: names marked, numbers whole and apart from what follows them, no other punctuation."""
    marks = NAME + NUMBER + UNIT
    text = F.when(text.rlike(f"[{marks}]"), F.translate(text, marks, "   ")).otherwise(text)
    text = F.regexp_replace(text, r"(?=\p{Lu}\p{Ll})(?<![\p{L}\p{N}])", NAME)
    # possessive, as below; what can be told from one character comes before what looks back
    apart = rf"[^\p{{L}}\p{{N}}{NAME}.,:/]|[.,:/](?:(?![0-9])|(?<![0-9][.,:/]))"
    text = F.regexp_replace(text, rf"(?:{apart})++", " ")
    return F.btrim(F.regexp_replace(text, r"[0-9](?=\p{L})", "$0 "))


def _template(clean: Column) -> Column:
    # possessive: else each name of a run takes frames of the thread's stack
    text = F.regexp_replace(clean, rf"{NAME}[^ ]++(?: {NAME}[^ ]++)*+", NAME)
    text = F.regexp_replace(text, r"[0-9](?<![^ ][0-9])[0-9.,:/]*", NUMBER)
    text = F.lower(text)
    return F.regexp_replace(text, rf"{NUMBER} (?:{'|'.join(UNITS)})(?= |$)", f"{NUMBER} {UNIT}")


def _split(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def templates(table: DataFrame, *keys: str, values: bool) -> DataFrame:
    """keys, ``template`` (array of words) and, if asked, ``words`` of the same length."""
    clean = table.select(*keys, _clean(F.coalesce("text", F.lit(""))).alias("clean"))
    found = [_split(_template(F.col("clean"))).alias("template")]
    if values:
        runs = F.regexp_replace("clean", rf"({NAME}[^ ]+) (?={NAME})", "$1")
        found.append(_split(F.regexp_replace(F.lower(runs), NAME, "")).alias("words"))
    return clean.select(*keys, *found)


def _windows(size: int) -> Column:
    """Hashes of all windows of one size; empty if there are too few words."""
    t = F.col("template")
    hashed = F.transform(F.sequence(F.lit(0), F.size(t) - size), lambda i: F.xxhash64(F.lit(size), *[t[i + k] for k in range(size)]))
    return F.when(F.size(t) >= size, hashed).otherwise(F.array().cast("array<bigint>"))


def _window_rows(table: DataFrame, key: str, sizes: list[int]) -> DataFrame:
    """key and hash, a row for each window of the sizes: places are exploded, not hashes, so that hashing is compiled with the join that follows."""
    t, n, at = F.col("template"), F.col("size"), F.col("at")
    table = table.withColumn("size", F.explode(F.array(*map(F.lit, sizes))) if len(sizes) > 1 else F.lit(sizes[0]))
    table = table.withColumn("at", F.explode(F.when(F.size(t) >= n, F.sequence(F.lit(0), F.size(t) - n)).otherwise(F.array().cast("array<int>"))))
    hashed = [F.when(n == size, F.xxhash64(F.lit(size), *[t[at + k] for k in range(size)])) for size in sizes]
    return table.select(key, F.coalesce(*hashed).alias("hash"))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """asked (item and form), item_id, hash, at, size, n_windows, and the template and words of the window."""
    named = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    folded = F.explode(F.array(F.struct(F.lit("names").alias("form"), "text"), F.struct(F.lit("no names").alias("form"), F.lower("text").alias("text"))))
    named = named.select("item_id", F.md5(F.col("text").cast("binary")).alias("digest"), folded.alias("f")).select("item_id", "digest", "f.*")
    items = templates(named, "item_id", "digest", "form", values=True).where(F.size("template") > 0)
    # one that has no names has only one form
    items = items.groupBy("item_id", "digest", "template", "words").agg(F.min("form").alias("form"))
    item = F.concat_ws(":", F.coalesce(F.col("item_id").cast("string"), F.lit("none")), "digest", "form")
    size = F.least(F.size("template"), F.lit(WINDOW))
    each = items.select(item.alias("asked"), "item_id", "template", "words", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("template") - size)).alias("at"))
    part = lambda c: F.slice(c, F.col("at") + 1, F.col("size"))
    each = each.select("asked", "item_id", "at", "size", part("template").alias("template"), part("words").alias("item_words"))
    literal = F.size(F.filter("template", lambda w: ~w.isin(NAME, NUMBER, UNIT)))
    each = each.withColumn("literal", literal >= F.least(F.lit(MIN_LITERAL), F.col("size")))
    said = each.groupBy("asked").agg(F.max("literal").alias("says"), F.sum(F.col("literal").cast("int")).alias("n"), F.count("*").alias("m"))
    each = each.join(said, "asked").where("literal OR NOT says")
    # the first word of an item may have a small letter inside a sentence, or a capital where the item has none
    first = F.when(F.col("template")[0] == NAME, F.col("item_words")[0]).otherwise(F.lit(NAME))
    other = F.concat(F.array(first), F.slice("template", F.lit(2), F.greatest(F.col("size") - 1, F.lit(0))))
    forms = F.when((F.col("at") == 0) & ~F.col("template")[0].isin(NUMBER, UNIT), F.array(F.col("template"), other)).otherwise(F.array("template"))
    each = each.withColumn("template", F.explode(forms))
    hashed = F.xxhash64(F.col("size"), *[F.get("template", F.lit(k)) for k in range(WINDOW)])
    return each.select("asked", "item_id", hashed.alias("hash"), "at", "size", F.when(F.col("says"), F.col("n")).otherwise(F.col("m")).alias("n_windows"), "template", "item_words")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(name, item_id, n_windows, n_item_windows, n_slots, n_changed, kind) by digest of the text."""
    table = settle(benchmark_windows(benchmark), "benchmark-windows")
    sizes = sorted(r[0] for r in table.df.select("size").distinct().collect())  # at most WINDOW numbers
    if not sizes:
        return docs.sparkSession.createDataFrame([], "name string, item_id long, n_windows long, n_item_windows long, n_slots long, n_changed long, kind string")
    named = docs.where("text IS NOT NULL").select(F.md5(F.col("text").cast("binary")).alias("name"), "text")
    each = _window_rows(templates(named, "name", values=False), "name", sizes)
    wanted = table.df.select("hash").distinct()
    found = join_small(each, wanted, ["hash"], "left_semi", spread=["name"], fits=table.fits).select("name").distinct()
    found = settle(found, "matching-texts")

    # the few texts that match are read again, with the values of their slots
    texts = join_small(named, found.df, ["name"], "left_semi", fits=found.fits)
    texts = templates(texts.groupBy("name").agg(F.min("text").alias("text")), "name", values=True)
    spots = F.concat(*[F.transform(_windows(n), lambda h, i: F.struct(h.alias("hash"), i.alias("spot"))) for n in sizes])
    hits = store(texts, "matching-words")
    spots = hits.select("name", F.explode(spots).alias("s")).select("name", "s.hash", "s.spot")
    spots = join_small(spots, table.df, ["hash"], "inner", spread=["name"], fits=table.fits)
    part = lambda c: F.slice(c, F.col("spot") + 1, F.col("size"))
    read = spots.join(hits.withColumnRenamed("template", "doc_template"), "name").where(part("doc_template") == F.col("template"))
    slots = F.filter(
        F.transform("template", lambda w, k: F.struct(w.alias("kind"), (F.col("at") + k).alias("place"), F.col("item_words")[k].alias("item"), F.col("words")[F.col("spot") + k].alias("doc"))),
        lambda s: s["kind"].isin(NAME, NUMBER, UNIT),
    )
    aligned = store(read.select("name", "asked", "item_id", (F.col("spot") - F.col("at")).alias("shift"), "at", "size", "n_windows", slots.alias("slots")), "matches")
    key = ["name", "asked", "item_id", "shift"]
    runs = aligned.groupBy(*key).agg(
        F.sort_array(F.collect_set("at")).alias("ats"), F.max("n_windows").alias("n_item_windows"), F.max("size").alias("size")
    )
    values = aligned.select(*key, F.explode("slots").alias("s")).select(*key, "s.place", "s.kind", "s.item", "s.doc").distinct()
    # the nearest place before that has the same value in the item and another one in the document
    along = Window.partitionBy(*key, "kind", "item").orderBy("place")
    values = values.withColumn("turn", F.when(F.lag("doc").over(along) != F.col("doc"), F.lag("place").over(along)))
    values = values.withColumn("against", F.last("turn", ignorenulls=True).over(along))
    values = values.groupBy(*key).agg(
        F.collect_set(F.struct("place", (F.col("item") != F.col("doc")).alias("changed"))).alias("slots"),
        F.collect_set(F.when(F.col("against").isNotNull(), F.struct("place", "against"))).alias("apart"),
        F.count("turn").alias("turns"),
    )
    no_slots, no_turns = F.array().cast("array<struct<place:int,changed:boolean>>"), F.array().cast("array<struct<place:int,against:int>>")
    judged = runs.join(values.drop("item_id"), ["name", "asked", "shift"], "left").withColumn("slots", F.coalesce("slots", no_slots)).withColumn("apart", F.coalesce("apart", no_turns))
    end = lambda t: t + F.col("size") - 1
    # for each window the longest stretch that ends with it and has no contradiction
    low = lambda t: F.coalesce(F.array_max(F.filter("apart", lambda c: c["place"] <= end(t))["against"]) + 1, F.lit(0))
    stretch = lambda t, least: F.filter("ats", lambda a: (a >= least) & (a <= t))
    covered = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, end(a))))))
    whole = F.coalesce("turns", F.lit(0)) * MIN_LITERAL <= covered - F.size("slots")
    stretches = F.when(whole, F.array("ats")).otherwise(F.transform("ats", lambda t: stretch(t, low(t))))
    judged = judged.withColumn("run", F.array_max(F.transform(stretches, lambda r: F.struct(F.size(r).alias("n"), r.alias("ats")))))
    inside = lambda s: (s["place"] >= F.col("run.ats")[0]) & (s["place"] <= end(F.element_at("run.ats", -1)))
    judged = judged.where(F.col("run.n") >= F.least(F.lit(MIN_RUN), F.col("n_item_windows"))).select(
        "name", "item_id", F.col("run.n").cast("long").alias("n"), "n_item_windows",
        F.size(F.filter("slots", inside)).alias("n_slots"), F.size(F.filter("slots", lambda s: inside(s) & s["changed"])).alias("n_changed"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    best = judged.groupBy("name", "item_id").agg(
        F.max(F.struct("n", "n_item_windows", (-zero(F.col("n_changed"))).alias("same"), zero(F.col("n_slots")).alias("n_slots"))).alias("b")
    )
    return best.select(
        "name",
        F.col("item_id").cast("long").alias("item_id"),
        F.col("b.n").alias("n_windows"),
        F.col("b.n_item_windows").cast("long").alias("n_item_windows"),
        F.col("b.n_slots").alias("n_slots"),
        (-F.col("b.same")).alias("n_changed"),
        F.when(F.col("b.same") == 0, "verbatim").otherwise("reparameterised").alias("kind"),
    )


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id and the columns of ``contaminated``: one row per row of ``docs`` and item it holds."""
    found = settle(contaminated(docs, benchmark), "contaminated")
    named = docs.where("text IS NOT NULL").select("doc_id", F.md5(F.col("text").cast("binary")).alias("name"))
    return join_small(named, found.df, ["name"], "inner", spread=["doc_id"], fits=found.fits).drop("name")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all columns, that hold no item of the benchmark."""
    found = settle(contaminated(docs, benchmark).select("name").distinct(), "contaminated")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    named = docs.select(row, F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("name"))
    return join_small(named, found.df, ["name"], "left_anti", spread=["name"], fits=found.fits).select("row.*")
