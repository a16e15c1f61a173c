import random
import re

from longform.llm import pii
from longform.llm.pii import find_pii, listed, sanitise


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c)
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in re.finditer(pii.EMAIL_PLAIN, text)]
    out += [("ip", *m.span()) for m in re.finditer(pii.IP_PLAIN, text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(pii.CARD_PLAIN, text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in re.finditer(pii.PHONE_PLAIN, text) if 9 <= len(digits(m)) <= 15]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


def spans(docs):
    from pyspark.sql import functions as F

    rows = find_pii(docs).select("doc_id", listed(F.col("base")).alias("base"), listed(F.col("terms")).alias("terms")).collect()
    return {r.doc_id: (r.base, r.terms) for r in rows}


def test_base_spans_match_the_plain_patterns(documents):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab1234567890.@-+ ()_%é😀") for _ in range(rng.choice([0, 5, 40, 300])))) for i in range(1500)]
    rows += [
        (2001, "4111 1111 1111 1111 x 4111-1111-1111-1111-1 4111111111111111"),
        (2002, "a@b.c_d@e.f 1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 1.2.3.256"),
        (2003, "1 " * 3000),
        (2004, "1" * 3000),
        (2005, "a@b.c.@x.y %%a@b.c a@b a@b. x@y@z.org"),
    ]
    got = spans(documents(rows))
    assert {i: got[i][0] for i, _ in rows} == {i: brute(t) for i, t in rows}


def corpus():
    rows = [(i, f"word{'abcdefghij'[i % 10]} plain filler number {i} common") for i in range(40)]
    # the entity occurs in four texts; 'zanzibar' only there, 'common' everywhere, 'rarely' in too few of them
    rows += [(100 + i, f"call +1 (555) 123-4567 common zanzibar {'rarely' if i < 2 else 'often'} text {i}") for i in range(4)]
    rows += [(110 + i, f"call +1 (555) 123-4567 common zanzibar extra copy {0}") for i in range(5)]  # one text, five copies
    return rows


def test_disclosing_terms(documents):
    got = spans(documents(corpus()))
    text = dict(corpus())
    for i in (100, 101, 102, 103, 110, 114):
        a = text[i].index("zanzibar")
        words = {text[i][int(s.split(":")[1]) : int(s.split(":")[2])] for s in got[i][1].split(",")}
        assert f"term:{a}:{a + 8}" in got[i][1].split(",")
        assert "common" not in words and "rarely" not in words and "copy" not in words
    assert all(got[i] == ("", "") for i in range(40))


def tells(n_et, n_t, n_e, n, words):
    """The rule, by hand: a lower bound of p(e | t), and how many words would do as well by chance."""
    from math import log2, sqrt

    if n_et < 2 or n_e == n:
        return False
    p, z = n_et / n_t, pii.CONFIDENCE
    low = (p + z * z / 2 / n_t - z * sqrt(p * (1 - p) / n_t + z * z / 4 / n_t**2)) / (1 + z * z / n_t)
    ways = 0 if p == 1 else -n_t * (p * log2(p) + (1 - p) * log2(1 - p))
    return log2(low * n / n_e) >= pii.DISCLOSURE * log2(n / n_e) and log2(words) + ways + n_et * log2(n_e / n) <= log2(pii.CHANCE)


def test_many_entities_match_brute_force(documents):
    """Entities of one to forty texts, terms that go with them more or less often: every branch of the rule."""
    rng = random.Random(12)
    names = [f"user{i}@mail.example" for i in range(12)]
    common = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = []
    for i in range(500):
        held = [k for k in range(12) if rng.random() < (k + 1) / 130]
        words = rng.choices(common, k=8) + [f"once{i}x"] + ([f"twin{i // 2}x"] if i % 5 == 0 else [])
        for k in held:
            words += [names[k]] + [f"term{k}x{j}" for j in range(4) if rng.random() < (1, 0.9, 0.6, 0.3)[j]]
        words += [f"term{rng.randrange(12)}x{rng.randrange(4)}"] * (rng.random() < 0.1)
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
    texts = {t for _, t in rows}
    has = {t: (set(t.split()) - set(names), {w for w in names if w in t.split()}) for t in texts}
    n, want = len(texts), set()
    for e in names:
        with_e = [t for t in texts if e in has[t][1]]
        beside = set().union(*[has[t][0] for t in with_e]) if with_e else set()
        for w in beside:
            n_et, n_t = sum(w in has[t][0] for t in with_e), sum(w in has[t][0] for t in texts)
            if tells(n_et, n_t, len(with_e), n, len(beside)):
                want.add(w)
    got, text = spans(documents(rows)), dict(rows)
    found = {i: term_words(got, text, i) for i, _ in rows}
    assert found == {i: want & has[t][0] for i, t in rows}
    assert 5 < len(want) < 48 and not any(w.startswith(("once", "twin")) for w in want)


def test_pmi_matches_brute_force(documents):
    rows = corpus()
    texts = {t for _, t in rows}
    words = {t: set(re.findall(r"(?<![^\W_])[^\W\d_]{4,}(?![0-9])", t)) for t in texts}
    holding = {t for t in texts if "+1 (555) 123-4567" in t}
    n, n_e = len(texts), len(holding)
    beside = set().union(*[set(re.findall(r"\w+", t.replace("+1 (555) 123-4567", " "))) for t in holding])
    want = set()
    for w in set().union(*words.values()):
        n_et, n_t = sum(w in words[t] for t in holding), sum(w in words[t] for t in texts)
        if n_et and tells(n_et, n_t, n_e, n, len(beside)):
            want.add(w)
    got = spans(documents(rows))
    seen = set()
    for i, t in rows:
        for s in filter(None, got[i][1].split(",")):
            _, a, b = s.split(":")
            seen.add(t[int(a) : int(b)])
    assert seen == want and "zanzibar" in want


def test_sanitise(documents, awkward):
    docs = documents([(1, "mail a.b@c.de now, +1 (555) 123-4567!"), (2, None), (3, ""), (4, "clean é text")])
    out = sanitise(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "mail <email> now, <phone>!", 2: None, 3: "", 4: "clean é text"}
    assert sanitise(awkward).count() == awkward.count()


def test_awkward_and_empty(awkward, nothing):
    got = spans(awkward)
    assert got[3] == got[4] == got[5] == got[7] == ("", "")
    assert got[9][0].startswith("email:0:6,phone:7:24")
    assert find_pii(nothing).count() == 0 and sanitise(nothing).count() == 0


def term_words(got, text, i):
    return {text[i][int(s.split(":")[1]) : int(s.split(":")[2])] for s in filter(None, got[i][1].split(","))}


def test_words_of_one_text_stay(documents):
    """A word that stands once shows no co-occurrence; the entity beside it is masked all the same, and so is a term of several texts."""
    rows = [(i, f"plain filler words {'common' if i % 2 else 'usual'}") for i in range(30)]
    rows += [(30 + i, f"plain filler words number{'abcdefghijklmnopqrstuvwxyzabcdefgh'[i]}{'xyz'[i % 3]}") for i in range(34)]
    rows += [(100, "plain words zanzibar common a.b@c.de")]
    rows += [(101 + i, f"plain words samarkand {'xyzuvw'[i]}{i} x.y@z.org") for i in range(6)]
    got, text = spans(documents(rows)), dict(rows)
    assert got[100] == ("email:28:36", "")
    assert all(term_words(got, text, 101 + i) == {"samarkand"} and "email" in got[101 + i][0] for i in range(6))
    assert all(not got[i][1] for i, _ in rows if i < 100)


def test_terms_of_any_length_in_all_documents(documents):
    rows = [(i, f"plain filler words {'abcdefghijklmnopqrstuvwxyz'[i % 26]} 我们今天去 on of {i}") for i in range(400)]
    rows += [(100 + i, f"call +1 (555) 123-4567 or Ann on project AB12, 我们和王伟说 of {i}") for i in range(4)]
    rows += [(200, "plain words of Ann on AB12 and 今天王伟去"), (None, "words of Ann"), (201, "plain words of Annabel")]
    docs, text = documents(rows), dict(rows)
    got = spans(docs)
    assert {"Ann", "AB12"} <= term_words(got, text, 100) and "of" not in term_words(got, text, 100)
    assert got[200][0] == "" and {"Ann", "AB12", "王伟"} <= term_words(got, text, 200) and "plain" not in term_words(got, text, 200)
    assert term_words(got, text, None) == {"Ann"} and got[201] == ("", "")
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert "Ann" not in clean[200] and "王伟" not in clean[200] and clean[None] == "words of <term>" and clean[201] == text[201]
