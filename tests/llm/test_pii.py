import hashlib
import random
import re

from bilinea.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(m):
    return re.sub("[^0-9]", "", m[0])


def luhn(d):
    return sum(sum(divmod(2 * int(x), 10)) if i % 2 else int(x) for i, x in enumerate(d[::-1])) % 10 == 0


def slow(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_patterns_match_the_plain_ones():
    r = random.Random(2)
    for _ in range(20000):
        text = "".join(r.choice(["@", "a", ".", "b.c", "1", "22", "255", "+", " ", "-", "(", "é", "4539578763621486", "1.2.3.4"]) for _ in range(r.randrange(14)))
        assert pii.entities(text) == slow(text), text


def test_long_runs_take_no_quadratic_time():
    for text in ("1" * 300_000, "1." * 200_000, "a" * 500_000, "a.b-" * 100_000 + "@", "@a" * 200_000, "+1(" * 100_000, "+" + "1 " * 200_000 + "("):
        pii.entities(text)


def rows():
    out = []
    for i in range(40):
        out.append((i, f"filler{i} Mr. Quillfeather, wrote to a.b@example.com about the case {i}.", "x"))
    for i in range(40, 400):
        out.append((i, f"about the case wrote to nobody {i} and x{i}@example.org", "x"))
    return out + [(None, None, None), (400, "", "x"), (400, "", "x")]


def test_disclosing_terms(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, base string")
    got = {r["doc_id"]: r for r in pii.label(docs).collect()}
    assert len(got) == 402
    text = rows()[7][1]
    assert [text[t["start"] : t["end"]] for t in got[7]["terms"]] == ["Mr", "Quillfeather"]
    assert all(t["removed"] for t in got[7]["terms"])
    assert len(got[77]["base"]) == 1
    # the number stands in this document alone, beside an address that does so too
    assert [(rows()[77][1][t["start"] : t["end"]], t["removed"]) for t in got[77]["terms"]] == [("77", False)]
    assert not got[400]["base"] and not got[None]["base"]
    clean = {r["doc_id"]: r["clean_text"] for r in pii.sanitised(docs).collect()}
    assert clean[7] == "filler7 . , wrote to [EMAIL] about the case 7."
    assert clean[None] is None and clean[77] == "about the case wrote to nobody [70-79] and [EMAIL]"
    assert pii.label(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_digests(spark, tmp_path):
    from bilinea.llm.queries import op6_disclosure_pii

    spark.createDataFrame(rows(), "doc_id long, text string, base string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in op6_disclosure_pii(spark, str(tmp_path)).collect():
        text = next(t for d, t, _ in rows() if d == r["doc_id"])
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in slow(text or ""))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert r["spans"].startswith(base) and r["n_email"] == base.count("email")


def test_rare_entities_and_terms_far_from_them(spark):
    far = "about the case wrote to nobody " * 60
    docs = [(i, f"about the case wrote to nobody {i}") for i in range(400)]
    docs += [(1000, f"Zuckerthal, {far} 77310042 a.rare@example.com"), (1001, f"a.rare@example.com {far} Zuckerthal 77310042, the Zuckerthal"), (1002, f"Zuckerthal {far}")]
    got = {r["doc_id"]: r["terms"] for r in pii.label(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    shown = {d: [text[t["start"] : t["end"]] for t in got[d]] for d, text in docs}
    assert shown[1000] == ["Zuckerthal", "77310042"] and shown[1001] == ["Zuckerthal", "77310042", "Zuckerthal"] and shown[1002] == ["Zuckerthal"]
    assert not any(shown[i] for i in range(400))


def slow_terms(texts):
    """The spans of disclosing terms in each text, from counts over all pairs of an entity and a term."""
    edges = ".,;:!?\"'()[]{}<>|*#$%&…«»„“”‘’"

    def words(text):
        base, out = slow(text), []
        for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
            core = m[0].strip(edges)
            start = m.start() + len(m[0]) - len(m[0].lstrip(edges))
            if any(c.isalnum() for c in core) and all(start + len(core) <= a or start >= b for _, a, b in base):
                out.append((core.lower(), start, start + len(core)))
        return out

    held = [{(k, t[a:b].lower()) for k, a, b in slow(t)} for t in texts]
    inside = [{w for w, _, _ in words(t)} for t in texts]
    anywhere = [{w.strip(edges).lower() for w in re.findall(r"[^\x20\x09-\x0D]+", t)} for t in texts]
    n, chances = len(texts), {}
    for entity in set().union(*held):
        e = sum(entity in h for h in held)
        for term in set().union(*(i for i, h in zip(inside, held) if entity in h)):
            et = sum(entity in h and term in i for h, i in zip(held, inside))
            t = sum(term in a for a in anywhere)
            chance = (et + e / n) / (t + 1) if e < n and 10 * et >= e else 0
            chances[term] = max(chance, chances.get(term, 0))
    return [[(a, b, chances[w] >= 0.75) for w, a, b in words(t) if chances.get(w, 0) >= 0.5] for t in texts]


def test_marked_terms_match_brute_force(spark):
    r = random.Random(9)
    words = ["Ärger,", "(Ñandú)", "plain", "4711", "x-1", "«Zitat»", "…", "É", "12", "end.", "\u3000wide"] + [f"rare{i}" for i in range(90)]
    people = [f"p{i}@mail.org" for i in range(12)] + ["10.0.0.7", "+49 30 123456"]
    texts = []
    for _ in range(160):
        own = [words[int(len(words) * r.random() ** 2)] for _ in range(r.randrange(0, 14))]
        for k in r.sample(range(len(people)), r.choice([0, 0, 1, 2])):
            own += [people[k], *[f"Sign{k}", f"{9000 + k // 2},", f"(mark{k // 3})"][: r.randrange(4)]]
        r.shuffle(own)
        texts.append("".join(w + r.choice([" ", "\n", "  ", "\t"]) for w in own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: [tuple(t) for t in r["terms"]] for r in pii.label(docs).collect()}
    expected = slow_terms(texts)
    assert sum(map(len, expected)) > 50 and any(x[2] for e in expected for x in e) and not all(x[2] for e in expected for x in e)
    assert got == dict(enumerate(expected))


def test_generalised_terms():
    shown = {"4711": "[4000-4999]", "x-1": "[CODE]", "NATO": "[ACRONYM]", "Zuckerthal": "[NAME]", "ward": "[WORD]"}
    assert {t: pii.general(t) for t in shown} == shown


def test_ordinary_words_are_left_alone(spark):
    """Of documents without an entity hardly any has a marked term; names beside one or two entities are marked."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    planted = [(10**9, "Wulfila Brandymeyer sent it from wb.one@example.com"), (10**9 + 1, "ask Wulfila Brandymeyer at wb.one@example.com"), (10**9 + 2, "Eulalia Knopfloch, reach me at +49 30 1239876"), (10**9 + 3, "and so Wulfila Brandymeyer came")]
    planted += [(10**9 + k, f"Ottokar Filzmoser, of.three@example.com, on the {k}") for k in (4, 5, 6)]
    marked = pii.label(docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string"))).cache()
    free = marked.where("size(base) = 0")
    touched, n = free.where("size(terms) > 0").count(), free.count()
    words = marked.selectExpr("sum(size(terms))").first()[0]
    print(f"{touched} of {n} documents without an entity have a marked term; {words} words are marked")
    assert n > 9_000 and touched < 0.05 * n
    shown = {r["doc_id"]: {dict(planted)[r["doc_id"]][t["start"] : t["end"]] for t in r["terms"]} for r in marked.where("doc_id >= 1000000000").collect()}
    assert shown[10**9] >= {"Wulfila", "Brandymeyer"} and shown[10**9 + 1] >= {"Wulfila", "Brandymeyer"} and shown[10**9 + 3] >= {"Wulfila", "Brandymeyer"}
    assert shown[10**9 + 2] >= {"Eulalia", "Knopfloch"}
    removed = {r["doc_id"]: [t["removed"] for t in r["terms"]][:2] for r in marked.where("doc_id >= 1000000004").collect()}
    assert removed == {10**9 + k: [True, True] for k in (4, 5, 6)}
