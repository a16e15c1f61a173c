"""Personal data and the terms that give it away, in built-in functions only.

Base spans are found by pattern: e-mail and IP addresses, card numbers (Luhn) and phone
numbers. The patterns match what the plain ones (``EMAIL_PLAIN`` and so on) match; they only
begin where a match can begin and never step back, so long runs of digits or letters cost one pass.

Information-theoretic sanitisation adds terms. Every base value is a protected entity, whatever its number
of texts. With n documents, an entity e carries ``IC(e) = log2(n / n_e)`` bits, and a term t tells
``PMI(e, t) = log2(p(e | t) * n / n_e)`` of them. What n_et of n_t texts say of p(e | t) depends on how many they are, so
the lower end of its confidence interval (Wilson's, ``CONFIDENCE`` standard errors) is taken for it: three texts of three say less
than thirty of thirty. A term is masked in every document, with or without e, if by that bound it tells at least the share
``DISCLOSURE`` of IC(e), and if of all the words beside e fewer than ``CHANCE`` would be expected to share as many texts with
it by accident. A word that shares a single text with e shows no co-occurrence and stays. All counts are over all
documents, where texts that are the same count once (a copy is no further evidence). Words inside base spans are no terms.

Entities that occur in the same texts tell the same and are counted once. Tables are broadcast only if measured
within the limit of ``join_small``; else words are joined by shuffling, and the few words of very many texts apart
from the others. Null and empty texts have no spans. Terms belong to the text, so rows that repeat a doc_id, or
have none, are masked like any other. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from longform.sources.storage import Settled, join_small, settle, store

KINDS = ("email", "ip", "card", "phone", "term")
#: What a base span of each kind is.
EMAIL_PLAIN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP_PLAIN = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD_PLAIN = r"[0-9]([\x20-]?[0-9])+"
PHONE_PLAIN = r"\+[0-9][\x20().0-9-]+[0-9]"

# a run of local-part characters matches from its first character or not at all; after a match the next may begin at once
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# a maximal chain of digits with single separators, of 13 to 19 digits: shorter and longer chains fail anyway
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = PHONE_PLAIN
#: A term is a run of letters and digits of any length, or two Han characters side by side, as Han text has no blanks between words.
TERM = r"[\p{L}\p{N}]++"
HAN_PAIR = r"(?=(\p{IsHan}{2}))"

DISCLOSURE = 0.8
CONFIDENCE = 1.2816
CHANCE = 0.05
#: Words of more than one text in so many are joined apart from the others.
COMMON = 1000
SPAN = "struct<kind:int,start:int,stop:int,value:string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a value pass the Luhn check."""
    digits = _digits(value)
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, size - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), add) % 10 == 0


def spans_of(text: Column, pattern: str | Column, kind: int) -> Column:
    """All matches with their places in code points: the parts between matches and the matches themselves add up to them."""
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, regex, F.lit(0))
    gaps = F.split(text, regex, -1)
    sized = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(F.length(g).alias("g"), F.length(m).alias("n"), m.alias("m")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + x["n"]).alias("stop"), x["m"].alias("value"))
        return F.struct((start + x["n"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.aggregate(sized, empty, step, lambda acc: acc["out"])


def base_spans(text: Column) -> Column:
    """Valid base spans by kind, then place. Patterns run only where they can match."""
    ip_ok = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
    none = F.array().cast(f"array<{SPAN}>")
    kinds = [
        (text.contains("@"), EMAIL, lambda s: F.lit(True)),
        (text.rlike(IP), IP, lambda s: s["value"].rlike(ip_ok)),
        (text.rlike(CARD), CARD, lambda s: luhn(s["value"])),
        (text.contains("+"), PHONE, lambda s: F.length(_digits(s["value"])).between(9, 15)),
    ]
    each = [F.when(may, F.filter(spans_of(text, pattern, k), good)).otherwise(none) for k, (may, pattern, good) in enumerate(kinds)]
    return F.concat(*each)


def with_base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``base`` of every row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("base", base_spans(F.col("text")))


def entity_of(span: Column) -> Column:
    """A base value in one spelling: numbers by their digits."""
    numeric = span["kind"].isin(KINDS.index("card"), KINDS.index("phone"))
    return F.concat(span["kind"].cast("string"), F.lit(":"), F.when(numeric, _digits(span["value"])).otherwise(F.lower(span["value"])))


def _name(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def words_of(text: Column) -> Column:
    """The different words of a text that can be terms."""
    words = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))
    pairs = F.when(text.rlike(r"\p{IsHan}"), F.regexp_extract_all(text, F.lit(HAN_PAIR), F.lit(1))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(words, pairs))


def _met(rows: DataFrame, table: Settled, common: Settled) -> DataFrame:
    """``rows`` joined to ``table`` on ``term``; terms of very many texts never meet in one task."""
    if table.fits:
        return rows.join(F.broadcast(table.df), "term")
    often = join_small(table.df, common.df, ["term"], "left_semi", fits=common.fits)
    hot = join_small(rows, often, ["term"], "inner", fits=common.fits)
    rest = join_small(rows, common.df, ["term"], "left_anti", fits=common.fits)
    return hot.unionByName(rest.join(table.df, "term"))


def lower_bound(hits: Column, n: Column, z: float = CONFIDENCE) -> Column:
    """Lower end of Wilson's interval for a share of which ``hits`` of ``n`` were seen."""
    p = hits / n
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def expected_by_chance(n_et: Column, n_t: Column, p_e: Column, words: Column) -> Column:
    """log2 of (at least) how many of ``words`` words of n_t texts would share n_et texts with an entity of the share p_e of all."""
    q = n_et / n_t
    entropy = F.when(n_et < n_t, -q * F.log2(q) - (1 - q) * F.log2(1 - q)).otherwise(0.0)
    return F.log2(words) + n_t * entropy + n_et * F.log2(p_e)


def disclosing_terms(found: DataFrame, docs: DataFrame, share: float = DISCLOSURE) -> DataFrame | None:
    """(name, terms): the terms to mask in each text, by its digest. None if there is no entity.

    ``found``: rows of ``with_base_spans`` that have spans, stored. ``docs``: all documents.
    """
    held = found.select(_name(F.col("text")).alias("name"), F.explode("base").alias("span"))
    held = held.select("name", entity_of(F.col("span")).alias("entity")).distinct()
    # entities of the same texts tell the same: one of them stands for all
    sums = [F.bit_xor(F.xxhash64("name", F.lit(k))).alias(f"h{k}") for k in range(2)]
    entities = held.groupBy("entity").agg(F.count("*").alias("n_e"), *sums)
    entities = entities.groupBy("n_e", "h0", "h1").agg(F.min("entity").alias("entity"))
    protected = settle(entities.select("entity", "n_e"), "entities", n=F.count("*"))
    if not protected.metrics["n"]:
        return None
    pairs = join_small(held, protected.df, ["entity"], "inner", spread=["name"], fits=protected.fits)

    texts = found.groupBy(_name(F.col("text")).alias("name")).agg(F.first("text").alias("text"), F.first("base").alias("base"))
    texts = texts.select("name", words_of(F.col("text")).alias("all"), words_of(without(F.col("text"), F.col("base"))).alias("terms"))
    texts = store(texts, "words-beside")
    together = pairs.join(texts.select("name", "terms"), "name").select("entity", "n_e", F.explode("terms").alias("term"))
    together = store(together.groupBy("entity", "n_e", "term").agg(F.count("*").alias("n_et")), "co-occurrence")

    beside = settle(together.groupBy("entity").agg(F.count("*").alias("words")), "words-of-entities")
    # what meets an entity in one text alone cannot tell of it
    together = join_small(together.where("n_et > 1"), beside.df, ["entity"], "inner", spread=["term"], fits=beside.fits)
    candidates = settle(together.select("term").distinct(), "terms")
    every = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("name", _name(F.col("text")))
    copies = settle(every.groupBy("name").agg(F.count("*").alias("n")), "texts", texts=F.count("*"))
    again = settle(copies.df.where("n > 1").select("name"), "copied")
    # a text that occurs several times counts once
    single = join_small(every, again.df, ["name"], "left_anti", fits=again.fits)
    several = join_small(every, again.df, ["name"], "left_semi", fits=again.fits).groupBy("name").agg(F.first("text").alias("text"))
    once = single.select("name", "text").unionByName(several)
    occurs = once.select("name", F.explode(words_of(F.col("text"))).alias("term"))
    counted = occurs.join(F.broadcast(candidates.df), "term", "left_semi") if candidates.fits else occurs
    # words that a text holds inside base spans only do not count
    inside = texts.select(F.explode(F.array_except("all", "terms")).alias("term"))
    counted = counted.select("term", F.lit(1).alias("n")).unionByName(inside.select("term", F.lit(-1).alias("n")))
    n_t = settle(counted.groupBy("term").agg(F.sum("n").alias("n_t")).where("n_t > 0"), "term-counts")
    size = float(copies.metrics["texts"])
    common = settle(n_t.df.where(F.col("n_t") > size / COMMON).select("term"), "common-terms")

    n = F.lit(size)
    ic = F.log2(n / F.col("n_e"))
    pmi = F.log2(lower_bound(F.col("n_et"), F.col("n_t")) * n / F.col("n_e"))
    chance = expected_by_chance(F.col("n_et"), F.col("n_t"), F.col("n_e") / n, F.col("words"))
    telling = _met(together, n_t, common).where((ic > 0) & (pmi >= F.lit(share) * ic) & (chance <= F.log2(F.lit(CHANCE))))
    telling = settle(telling.select("term").distinct(), "disclosing")
    return _met(occurs, telling, common).groupBy("name").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def without(text: Column, spans: Column) -> Column:
    """The text with a blank for every span."""
    return masked(text, spans, F.lit(" "))


def term_spans(text: Column, terms: Column, base: Column) -> Column:
    """Places of the terms as whole words or pairs, outside base spans, in order. Pairs that overlap are one span."""
    pair = lambda t: t.rlike(r"^\p{IsHan}{2}$")
    words, pairs = F.filter(terms, lambda t: ~pair(t)), F.filter(terms, pair)
    whole = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(words, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    within = F.concat(F.lit("(?:(?="), F.array_join(pairs, "|"), F.lit(r")\p{IsHan})++\p{IsHan}"))
    regex = F.concat_ws("|", F.when(F.size(words) > 0, whole), F.when(F.size(pairs) > 0, within))
    found = spans_of(text, regex, KINDS.index("term"))
    return F.filter(found, lambda s: ~F.exists(base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))


def _with_terms(rows: DataFrame, terms: DataFrame | None) -> DataFrame:
    """Adds ``terms`` (spans) to rows with ``text`` and ``base``."""
    none = F.array().cast(f"array<{SPAN}>")
    if terms is None:
        return rows.withColumn("terms", none)
    telling = settle(terms, "text-terms")
    marked = join_small(rows.withColumn("name", _name(F.col("text"))), telling.df, ["name"], "left", fits=telling.fits).drop("name")
    return marked.withColumn("terms", F.when(F.col("terms").isNull(), none).otherwise(term_spans(F.col("text"), F.col("terms"), F.col("base"))))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, text (empty for null), base and terms (arrays of spans) of every row."""
    found = with_base_spans(docs)
    holding = store(found.where(F.size("base") > 0), "personal-data")
    return _with_terms(found, disclosing_terms(holding, docs)).select("doc_id", "text", "base", "terms")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def masked(text: Column, spans: Column, instead: Column | None = None) -> Column:
    """The text with every span replaced by its kind in angle brackets (or ``instead``); spans that overlap become one, named by the first."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        between = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        added = F.concat(acc["out"], between, F.concat(F.lit("<"), names[s["kind"]], F.lit(">")) if instead is None else instead)
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.when(fresh, added).otherwise(acc["out"]).alias("out"))

    return F.aggregate(ordered, empty, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame) -> DataFrame:
    """The rows with all columns, personal data and disclosing terms in ``text`` masked. Null texts stay null.

    The columns are carried beside the spans of the same row, so rows that repeat an id are never mixed up.
    """
    row = F.struct(*[F.col(c) for c in docs.columns])
    carried = docs.select(row.alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    holding = store(with_base_spans(docs).where(F.size("base") > 0), "personal-data")
    carried = _with_terms(carried.withColumn("base", base_spans(F.col("text"))), disclosing_terms(holding, docs))
    carried = carried.withColumn("spans", F.concat("base", "terms"))
    clean = F.when(F.size("spans") > 0, masked(F.col("text"), F.col("spans"))).otherwise(F.col("_row.text"))
    return carried.select(*[clean.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
