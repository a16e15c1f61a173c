import random
import re

from pyspark.sql import functions as F

from longform.llm import decontamination
from longform.llm.decontamination import contaminated_documents, decontaminate

ITEM = "Tom has 12 apples and gives 5 apples to Anna every day, how many apples are left?"
ITEMS = "item_id long, text string"


def found(spark, documents, rows, items):
    got = contaminated_documents(documents(rows), spark.createDataFrame(items, ITEMS)).collect()
    return {(r.doc_id, r.item_id, r.kind) for r in got}


def test_verbatim_and_reparameterised(spark, documents):
    rows = [
        (1, f"Some words before. {ITEM} And after."),
        (2, "so Berta has 30 apples and gives 7 apples to Carl every day, how many apples are left?"),
        (3, "tom HAS 12 apples, and gives 5 apples to Anna every day -- how many apples are left"),
        (4, "Tom has apples and gives apples to many people who like to eat fruit on all days"),
        (5, "Clean text that has nothing to do with it at all, and goes on for some more words"),
    ]
    assert found(spark, documents, rows, [(7, ITEM)]) == {(1, 7, "verbatim"), (2, 7, "reparameterised"), (3, 7, "verbatim")}


def test_slots_must_agree(spark, documents):
    item = "take 3 red and 3 green and 3 blue and 3 white and 3 black stones home with you"
    same = item.replace("3", "8")
    mixed = "take 8 red and 9 green and 7 blue and 6 white and 5 black stones home with you"
    assert found(spark, documents, [(1, same), (2, mixed)], [(1, item)]) == {(1, 1, "reparameterised")}


def test_units_and_short_items(spark, documents):
    rows = [(1, "a road of 5km runs past here"), (2, "a road of 90 miles runs past here"), (3, "a road past here")]
    got = found(spark, documents, rows, [(1, "a road of 12 km runs past here"), (2, None), (3, ""), (None, "a road of 12 km runs past here")])
    assert {(i, j) for i, j, _ in got} == {(1, 1), (2, 1), (1, None), (2, None)}


def test_decontaminate_keeps_columns_and_rows(spark, documents, awkward):
    docs = documents([(1, ITEM), (2, None), (3, ""), (4, "else"), (4, "else"), (None, "else")])
    kept = decontaminate(docs, spark.createDataFrame([(1, ITEM)], ITEMS))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "4", "4", "None"]
    assert decontaminate(awkward, spark.createDataFrame([(1, ITEM)], ITEMS)).count() == awkward.count()


def test_empty(spark, nothing, awkward):
    none = spark.createDataFrame([], ITEMS)
    assert contaminated_documents(nothing, spark.createDataFrame([(1, ITEM)], ITEMS)).count() == 0
    assert contaminated_documents(awkward, none).count() == 0
    assert decontaminate(awkward, none).count() == awkward.count()


def test_one_contradiction_does_not_discard_an_alignment(spark, documents):
    words = [f"word{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    item = " ".join(["start", "10", *words[:20], "10", *words[20:], "end"])
    fruit = "a farmer puts 2 apples and 2 pears into each of the baskets that stand on the long table today"
    mixed = "take 3 red and 3 green and 3 blue and 3 white and 3 black stones home with you"
    tail = " and then sort all of them by size before the others come back again"
    rows = [
        (1, item.replace("wordt 10", "wordt 11")),
        (2, fruit.replace("2 apples", "3 apples").replace("2 pears", "5 pears")),
        (3, "take 8 red and 9 green and 7 blue and 6 white and 5 black stones home with you"),
        (4, "take 8 red and 9 green and 7 blue and 6 white and 5 black stones home with you" + tail),
    ]
    got = found(spark, documents, rows, [(1, item), (2, fruit), (3, mixed), (4, mixed + tail)])
    assert {(i, j) for i, j, _ in got if i == j} == {(1, 1), (2, 2), (4, 4)}


QUESTION = "Tom has 12 apples. Tom gives 5 to Ann. Tom eats 2 of them. How many apples has Tom now after lunch at school?"


def test_copies_in_other_case_and_other_names(spark, documents):
    rows = {
        "same": (QUESTION, "verbatim"),
        "small": (QUESTION.lower(), "verbatim"),
        "capitals": (QUESTION.upper(), "verbatim"),
        "wrapped": ("so: " + QUESTION.replace(". ", ".\n").replace(" of ", "\n  of "), "verbatim"),
        "bare": (QUESTION.replace(".", "").replace("?", ""), "verbatim"),
        "numbers": (QUESTION.replace("12", "30").replace("5", "7"), "reparameterised"),
        "numbers, small": (QUESTION.lower().replace("12", "30").replace("5", "7"), "reparameterised"),
        "name at a start": (QUESTION.replace("Tom", "Berta"), "reparameterised"),
        "run of names": (QUESTION.replace("to Ann.", "to Mary Ann."), "reparameterised"),
        "inside": ("we ask how many apples there are and t" + QUESTION[1:], "verbatim"),
        "clean": ("Nobody at school eats lunch, and 12 apples cost 5 of them. How are you now, Tom?", None),
    }
    got = found(spark, documents, [(i, text) for i, (text, _) in enumerate(rows.values())], [(1, QUESTION)])
    kinds = {i: kind for i, _, kind in got}
    assert {name: kinds.get(i) for i, name in enumerate(rows)} == {name: kind for name, (_, kind) in rows.items()}


def test_reserved_characters_and_clashing_names(spark, documents):
    marked = documents([(1, ITEM.replace("12", "\ue000 \ue001 \ue002")), (2, "\ue000" + ITEM)]).withColumn("_text_digest", F.lit("mine"))
    kept = decontaminate(marked, spark.createDataFrame([(1, ITEM)], ITEMS)).collect()
    assert [(r.doc_id, r._text_digest) for r in kept] == []
    assert decontaminate(marked, spark.createDataFrame([(1, "nothing of the kind is ever asked of them")], ITEMS)).count() == 2


def test_items_without_or_with_shared_ids(spark, documents):
    items = [(None, QUESTION), (None, ITEM), (4, QUESTION), (4, ITEM), (4, ITEM)]
    got = found(spark, documents, [(1, f"{QUESTION} {ITEM}"), (2, ITEM.upper()), (None, QUESTION)], items)
    assert got == {(i, j, "verbatim") for i in (1, 2, None) for j in (None, 4)}


def test_long_runs_of_names(spark, documents):
    """One run is one placeholder, however many names it has."""
    names = " ".join(["Ann", "Berta", "Émile"] * 50_000)
    rows = [(1, f"{names} and {ITEM}"), (2, ITEM.replace("Anna", names)), (3, names), (4, f"{names}, {names.lower()}")]
    assert found(spark, documents, rows, [(1, ITEM)]) == {(1, 1, "verbatim"), (2, 1, "reparameterised")}


def test_long_runs_of_separators(spark, documents):
    rows = [(1, " .,:/-\n" * 50_000 + ITEM), (2, ITEM.replace(" apples", "." * 100_000 + "apples")), (3, ":" * 100_000), (4, "1." * 100_000)]
    assert found(spark, documents, rows, [(1, ITEM)]) == {(1, 1, "verbatim"), (2, 1, "verbatim")}


def test_words_are_cut_as_by_separate_steps(spark):
    """One expression cuts the words; here its parts one after another, on every short mix of the characters that matter."""
    name, rng = decontamination.NAME, random.Random(5)
    texts = ["".join(rng.choice("aZz07.,:/ -\n\u00e9\U00010400\U0001f600_") for _ in range(rng.randint(1, 14))) for _ in range(5000)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    steps = F.regexp_replace("text", r"(?=\p{Lu}\p{Ll})(?<![\p{L}\p{N}])", name)
    steps = F.regexp_replace(steps, rf"(?<![0-9])[.,:/]|[.,:/](?![0-9])|[^\p{{L}}\p{{N}}{name}.,:/]+", " ")
    steps = F.btrim(F.regexp_replace(steps, r"(?<=[0-9])(?=\p{L})| {2,}", " "))
    numbers = F.regexp_replace(F.regexp_replace(steps, rf"{name}[^ ]++(?: {name}[^ ]++)*+", name), r"(?<![^ ])[0-9][0-9.,:/]*", decontamination.NUMBER)
    clean = decontamination._clean(F.col("text"))
    got = rows.select("text", clean.alias("clean"), steps.alias("steps"), decontamination._template(clean).alias("t"), F.lower(numbers).alias("n")).collect()
    assert [r for r in got if r.clean != r.steps or r.t != r.n] == []


def test_windows_are_compiled(spark, documents):
    """A row for each window of a text, whatever the sizes; no function on arrays that Spark interprets."""
    rows = documents([(1, "a b c d e f g h i j a b c d e f g h"), (2, "a b"), (3, ""), (4, "a b c d e f g h i"), (4, "a b c d e f g h i")])
    table = decontamination.templates(rows, "doc_id", values=False)
    for sizes in ([8], [2, 8], [1, 3, 9]):
        got = decontamination._window_rows(table, "doc_id", sizes)
        want = table.select("doc_id", F.explode(F.concat(*map(decontamination._windows, sizes))).alias("hash"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert "lambda" not in got._jdf.queryExecution().executedPlan().toString()
        assert "lambda" in want._jdf.queryExecution().executedPlan().toString()


# -- brute force -----------------------------------------------------------------

VOCABULARY = [f"{a}{b}{c}" for a in "bdgklmnprst" for b in "aeiou" for c in ("", "n", "r", "st")]
PEOPLE = ["Ann", "Berta", "Carl", "Dora", "Émile", "Frieda", "Gustav", "Hanna"]


def forms_of(text):
    """Template words, read word by word."""
    out = []
    for word in re.findall(r"[^\W_]+", text):
        if re.match(r"\d", word):
            out.append("#")
        elif re.match(r"[A-ZÉ][a-zé]", word):
            if out[-1:] != ["@"]:
                out.append("@")
        else:
            out.append(word.lower())
    return out


def shared_windows(text, item):
    """Most windows of one alignment that hold at least four literal words, over both forms of the item."""
    best, words = 0, forms_of(text)
    for form in {tuple(forms_of(item)), tuple(forms_of(item.lower()))}:
        for shift in range(-len(form), len(words)):
            n = 0
            for at in range(len(form) - 7):
                same = at + shift >= 0 and form[at : at + 8] == tuple(words[at + shift : at + shift + 8])
                n += same and sum(w not in "#@" for w in form[at : at + 8]) >= 4
            best = max(best, n)
    return best


def _question(rng):
    """14 to 40 words, of which every fifth may be a number or one of two names; the first has a capital."""
    who = rng.sample(PEOPLE, 2)
    words = [rng.choice(VOCABULARY) for _ in range(rng.randint(14, 40))]
    for at in range(3, len(words), 5):
        words[at] = rng.choice([str(rng.randint(2, 99)), rng.choice(who), words[at]])
    return " ".join([words[0].capitalize(), *words[1:]])


def test_generated_items_against_brute_force(spark, documents):
    rng = random.Random(12)
    items = [_question(rng) for _ in range(40)]
    fill = lambda: " ".join(rng.choice(VOCABULARY) for _ in range(30))
    rows, planted = [], {}

    def plant(kind, item, text):
        planted.setdefault(kind, []).append((len(rows), item))
        rows.append((len(rows), f"{fill()}. {text}. {fill()}"))

    for k, item in enumerate(items):
        plant("verbatim", k, item)
        plant("verbatim", k, item.lower())
        plant("verbatim", k, item.upper())
        plant("verbatim", k, item.replace(" ", "\n", 6))
        new = dict(zip(PEOPLE, rng.sample(PEOPLE, len(PEOPLE)), strict=True))
        other = re.sub(r"[^\W\d_]+", lambda m: new.get(m.group(), m.group()), item)
        plant("names", k, other)
        plant("numbers", k, re.sub(r"\d+", lambda m: str(int(m.group()) + 100), other))
    rows += [(len(rows) + i, fill()) for i in range(50)]
    got = contaminated_documents(documents(rows), spark.createDataFrame(list(enumerate(items)), ITEMS)).collect()
    pairs = {(r.doc_id, r.item_id): r.n_windows for r in got}
    assert all(p in pairs for p in planted["verbatim"])
    for kind in ("names", "numbers"):
        assert sum(p in pairs for p in planted[kind]) >= 0.9 * len(planted[kind])
    assert set(pairs) <= {p for some in planted.values() for p in some}
    want = {p: shared_windows(rows[p[0]][1], items[p[1]]) for p in planted["verbatim"]}
    assert {p: pairs[p] for p in want} == want
