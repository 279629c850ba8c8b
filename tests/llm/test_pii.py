import math
import random
import re

from corpus import documents, table
from pyspark.sql import functions as F

from evenkeel.llm import pii
from evenkeel.llm.common import cut

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(value):
    d = [int(c) for c in value if c.isdigit()][::-1]
    return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


KEEPS = [
    ("email", EMAIL, lambda v: True), ("ip", IP, lambda v: all(int(p) <= 255 for p in v.split("."))),
    ("card", CARD, luhn), ("phone", PHONE, lambda v: 9 <= sum(c.isdigit() for c in v) <= 15),
]


def brute(text):
    found = [(m.start(), k, m.end()) for k, (_, pattern, ok) in enumerate(KEEPS) for m in pattern.finditer(text or "") if ok(m.group())]
    return [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found)]


TRICKY = [
    "a@b.c_d@e.f, x@y, @z.com, a..b@c.d.e. \U0001F600 me@home.org", "1.2.3.4.5.6.7.8 999.1.1.1.1 000.01.2.255 1.2.3 256.1.1.1",
    "4111 1111 1111 1111 and 4111111111111112 and 5 4111-1111-1111-1111 and 4111111111111111000000", "+1 (555) 010-9999. +1234 +44 20 7946 0958 x +1 2",
    "z" * 4000 + "@" + "y" * 4000 + ".com", "9" * 5000, "1-" * 4000, "a@" * 3000, "+1" + "(" * 3000, "1." * 4000, "é" * 100 + " é@x.y 10.0.0.1",
]


def test_patterns_are_the_base(spark):
    rows = documents(6) + [(1000 + i, t) for i, t in enumerate(TRICKY)] + [(None, "a@b.co"), (None, None)]
    found = pii.find(table(spark, rows)).select("doc_id", pii.listed(pii.plain(F.col("spans"))).alias("s")).collect()
    texts = dict(rows)
    for r in found:
        if r["doc_id"] is not None:
            assert r["s"] == ",".join(brute(texts[r["doc_id"]])), r["doc_id"]
    assert sorted(r["s"] for r in found if r["doc_id"] is None) == ["", "email:0:6"]


def test_terms_that_disclose_are_found_and_treated(spark):
    plain = [(i, f"we say the usual words number {i} again and again") for i in range(40)]
    telling = [(100 + i, f"the usual words a{i} b{i} c{i} zanzibar d{i} e{i} f{i} write to boss@firm.example for it g{i} {'x' * i}") for i in range(4)]
    df = table(spark, plain + telling)
    terms = pii.find(df).select("doc_id", F.explode("terms").alias("t")).collect()
    texts = dict(plain + telling)
    seen = {(r["doc_id"], texts[r["doc_id"]][r["t"]["s"] : r["t"]["e"]]) for r in terms}
    assert {(i, "zanzibar") for i in range(100, 104)} <= seen
    assert not any(w in ("the", "usual", "words") for _, w in seen)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert all(clean[i] == t for i, t in plain)
    assert all("zanzibar" not in clean[i] and "boss@" not in clean[i] and "[EMAIL]" in clean[i] and "the usual words" in clean[i] for i in range(100, 104))


def test_sanitised_text_keeps_all_else(spark):
    text = "\U0001F600é call +1 (555) 010-9999 or 10.0.0.1@mail.example, ok é"
    df = table(spark, [(1, text), (2, None), (3, ""), (4, "clean")])
    got = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert got == {1: "\U0001F600é call [PHONE] or [EMAIL], ok é", 2: None, 3: "", 4: "clean"}
    assert pii.sanitise(df.limit(0)).isEmpty() and pii.find(df.limit(0)).isEmpty()
    assert pii.sanitise(df).columns == df.columns


def test_long_lists_keep_their_places(spark):
    text = " ".join(f"user{i}@host{i % 7}.example" for i in range(700))
    got = pii.find(table(spark, [(1, text)])).select(pii.listed(pii.plain(F.col("spans")))).first()[0]
    assert got == ",".join(brute(text))


def test_a_pair_that_stands_once_is_treated_if_each_pair_is_judged_by_itself(spark):
    plain = [(i, f"we say the usual words number {i} again") for i in range(200)]
    one = (900, "the usual words zanzibar at boss@firm.example")
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(table(spark, [*plain, one]), per_pair=True).collect()}
    assert "zanzibar" not in clean[900] and "the usual words" in clean[900]
    few = {r["doc_id"]: r["text"] for r in pii.sanitise(table(spark, [*plain[:20], one]), per_pair=True).collect()}
    assert "zanzibar" in few[900]  # one document in 21 may be chance
    # by all terms together: each of the plain texts has a number that stands nowhere else as well
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(table(spark, [*plain, one])).collect()}
    assert "zanzibar" in clean[900] and "[EMAIL]" in clean[900]
    twice = [*plain, one, (901, "zanzibar has boss@firm.example"), (902, "zanzibar or boss@firm.example")]
    assert not any("zanzibar" in r["text"] for r in pii.sanitise(table(spark, twice)).collect())


def lower(k, n):
    p = k / n
    return (p + 0.5 / n - math.sqrt(p * (1 - p) / n + 0.25 / n**2)) / (1 + 1 / n)


def disclosed_by_hand(rows):
    """The disclosing terms of each text by the formula, over all pairs of entities and terms; equal texts are one content."""
    docs = sorted(set(rows), key=str)
    contents = {text: (i, text) for i, text in reversed(docs)}.values()
    entity_docs, term_docs = {}, {}
    for i, text in contents:
        clear = text
        for m in EMAIL.finditer(text):
            entity_docs.setdefault(m.group().lower(), set()).add((i, text))
            clear = clear.replace(m.group(), " ")
        for w in re.findall(r"\w+", clear.lower()):
            term_docs.setdefault(w, set()).add((i, text))
    n = len(contents)
    occurrences = sum(map(len, term_docs.values()))

    def evidence(both, one, other):
        a, p = both / one, other / n
        return one * (a * math.log(a / p) + ((1 - a) * math.log((1 - a) / (1 - p)) if a < 1 else 0)) if a > p else 0

    told = set()
    for e in entity_docs.values():
        for w, t in term_docs.items():
            both, proof = len(e & t), math.log(occurrences / len(t) / pii.CHANCE)
            if both > 1 and max(evidence(both, len(e), len(t)), evidence(both, len(t), len(e))) >= proof - 1e-9:
                if 1 - math.log(lower(both - 1, len(t) - 1)) / math.log(len(e) / n) >= pii.GENERALISE:
                    told.add(w)
    return {d: sorted((w, m.start()) for m in re.finditer(r"\w+", d[1].lower()) if (w := m.group()) in told and "@" not in d[1][m.start() - 1 : m.end() + 1]) for d in docs}


def test_terms_are_those_of_the_formula(spark):
    rng = random.Random(4)
    common = [f"word{k}" for k in range(60)]
    rows = [(i, " ".join(rng.choice(common) for _ in range(25))) for i in range(300)]
    for p in range(12):  # people with a name, a town that others share, and some documents each
        for k in range(rng.randint(1, 6)):
            rows.append((1000 + 10 * p + k, f"{' '.join(rng.choice(common) for _ in range(12))} name{p} of town{p % 3} at p{p}@firm{p % 4}.example"))
    rows += [(2000 + i, f"name{i % 3} {rng.choice(common)}") for i in range(8)]
    rows += rows[:40] + rows[300:330] + rows[300:310]  # repeated rows are one document
    expected = disclosed_by_hand(rows)
    assert any(expected.values())
    found = pii.find(table(spark, rows)).select("doc_id", "key", "terms").collect()
    assert len(found) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t)
    for r in found:
        text = texts[r["doc_id"]]
        assert sorted((text[t["s"] : t["e"]].lower(), t["s"]) for t in r["terms"]) == expected[(r["doc_id"], text)], r["doc_id"]


def planted(seed=11, docs=1500):
    """Texts of common and own words; people whose name stands beside their address in different texts, and what should not count."""
    rng = random.Random(seed)
    common, rows = [f"word{k}" for k in range(400)], []
    text = lambda n, tag: " ".join(rng.choice(common) if rng.random() < 0.9 else f"own{tag}x{k}" for k in range(n))
    for i in range(docs):
        rows.append((i, text(40, i)))
    names = set()
    for p in range(10):  # found: in five different texts each
        names.add(f"name{p}")
        rows += [(5000 + 10 * p + k, f"{text(30, f'p{p}k{k}')} name{p} writes from person{p}@mail.example {text(8, f'q{p}k{k}')}") for k in range(5)]
    for p in range(10):  # not found: one text with an address, copied and nearly copied many times
        one = f"{text(60, f'c{p}')} other{p}@mail.example {text(8, f'd{p}')}"
        rows += [(6000 + 20 * p + k, one) for k in range(6)] + [(6000 + 20 * p + 6 + k, f"{one} end{p}x{k}") for k in range(6)]
    for p in range(30):  # not found: an address that stands once
        rows.append((7000 + p, f"{text(40, f's{p}')} single{p}@mail.example"))
    return rows, names


def test_names_beside_recurring_addresses_are_found_and_chance_words_are_not(spark):
    rows, names = planted()
    found = pii.find(table(spark, rows)).select("doc_id", F.explode("terms").alias("t")).collect()
    texts = dict(rows)
    words = [texts[r["doc_id"]][r["t"]["s"] : r["t"]["e"]] for r in found]
    hits = sum(w in names for w in words)
    assert {w for w in words if w in names} == names and hits == 50, "recall"
    assert hits >= 0.95 * len(words), "precision"


def test_copies_are_no_second_witness(spark):
    """Equal texts, and near-equal ones with the same entities, count once; near-equal ones with other entities do not."""
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(1, f"{base} a@b.co"), (2, f"{base} a@b.co"), (3, f"{base} a@b.co end"), (4, f"{base} c@d.co"), (5, base), (6, base), (7, f"{base} x"), (8, "a@b.co " + " ".join(f"v{k}" for k in range(60))), (None, base)]
    texts = table(spark, rows).select("doc_id", "text").withColumn("key", pii._key("doc_id", "text"))
    found = pii.base_spans(texts, "text").select("doc_id", "key", "spans", F.unhex(F.md5("text")).alias("content"))
    gone = [r["doc_id"] for r in pii._same_contents(texts, cut(found, "found")).join(texts, "key").collect()]
    left = [r for r in (1, 2, 3) if r not in gone]
    assert len(left) == 1 and 4 not in gone and 7 not in gone and 8 not in gone and sum(r in gone for r in (5, 6, None)) == 2


def test_many_spans_in_one_text_are_no_more_work_each(spark):
    text = " ".join(f"user{i}@host{i % 7}.example" for i in range(50_000))
    df = table(spark, [(1, text), (2, "clean"), (2, "clean")])
    assert pii.find(df).where("doc_id = 1").select(F.size("spans")).first()[0] == 50_000
    got = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert got == {1: " ".join(["[EMAIL]"] * 50_000), 2: "clean"}


def test_overlapping_spans_are_one(spark):
    df = spark.sql("select array(struct(0 s, 1 kind, 5 e), struct(3 s, 0 kind, 9 e), struct(4 s, 2 kind, 6 e), struct(9 s, 3 kind, 11 e), struct(20 s, 2 kind, 21 e), struct(20 s, 0 kind, 20 + 3 e)) spans")
    got = pii.united(df, F.col("spans"), "whole").first()["whole"]
    assert [(x["s"], x["kind"], x["e"]) for x in got] == [(0, 1, 9), (9, 3, 11), (20, 0, 23)]


def test_reserved_names_are_kept(spark):
    df = table(spark, [(1, "boss@firm.example"), (2, None)]).withColumns({"__key": F.lit("a"), "__merged": F.lit("b"), "__blocks": F.lit("c")})
    got = pii.sanitise(df)
    assert got.columns == df.columns and {(r["doc_id"], r["text"], r["__key"], r["__merged"], r["__blocks"]) for r in got.collect()} == {(1, "[EMAIL]", "a", "b", "c"), (2, None, "a", "b", "c")}


def test_terms_are_treated_wherever_they_stand(spark):
    plain = [(i, f"we say the usual words number {i} again 一二三四") for i in range(400)]
    far = "the usual words " * 10
    rows = [(800 + i, f"zanzibar user7x 王芳说 {far}write {' '.join(f'part{i}x{k}' for k in range(60))} to boss@firm.example") for i in range(9)] + [(900, f"zanzibar {far}"), (900, f"zanzibar {far}"), (901, "看王芳了 user7x")]
    found = pii.find(table(spark, plain + rows)).where("doc_id >= 800").select("doc_id", F.explode("terms").alias("t")).collect()
    texts = dict(rows)
    seen = {(r["doc_id"], texts[r["doc_id"]][r["t"]["s"] : r["t"]["e"]]) for r in found}
    assert {(i, w) for i in range(800, 809) for w in ("zanzibar", "user7x", "王芳")} <= seen
    assert {(900, "zanzibar"), (901, "user7x"), (901, "王芳")} <= seen and not {w for _, w in seen} & {"the", "usual", "words", "看王"}
    clean = pii.sanitise(table(spark, plain + rows)).collect()
    assert not any("zanzibar" in r["text"] or "王芳" in r["text"] or "user7x" in r["text"] for r in clean) and all(r["text"] == dict(plain)[r["doc_id"]] for r in clean if r["doc_id"] < 800)
