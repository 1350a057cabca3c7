import hashlib
import random
import re

from quarry.llm import pii

SCHEMA = "doc_id long, text string, start string, `left` string"


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def plain(text):
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((0, m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= sum(c.isdigit() for c in m.group() if c < "\x7f") <= 15:
            out.append((3, m.start(), m.end()))
    return sorted(out)


def made(n=250, seed=3):
    rnd = random.Random(seed)
    bits = ["a.b@c.de", "x@y", "é", "4111 1111 1111 1111", "4111-1111-1111-1112", "10.0.0.255", "1.2.3.256", "1.2.3.4.5.6.7.8",
            "+49 (30) 123-4567", "+1", "@", "a@b.c_d@e.f", " ", "-", ".", "007", "\x01", "😀", "12345678901234567890", "mail ",
            "4111111111111111", "00000000000000000000.1.1.1", "call 555-123-4567", "joe at mail dot com", "\n"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randrange(1, 14))) for _ in range(n)]


def test_base_spans_equal_brute_force(spark):
    texts = {i: t for i, t in enumerate(made())}
    texts.update({900: None, 901: "", 902: "a" * 60000, 903: "1" * 60000, 904: "a.b@" + "c." * 30000 + "d", 905: "+" + "1 " * 20000})
    rows = [(i, t, "s", None) for i, t in texts.items()] + [(5, texts[5], "again", None), (None, "me@x.org", "", None)]
    got = pii.find_pii(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain(texts[r.doc_id] if r.doc_id is not None else "me@x.org")
        line = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest(), (r, want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in want) for i in range(4)]
        spans = [tuple(x.split(":")) for x in r.spans.split(",") if x]
        assert {(pii.KINDS[k], str(a), str(b)) for k, a, b in want} <= set(spans)
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), int(s[1])))


def test_mask_and_empty_table(spark):
    rows = [(1, "é mail a@b.de or 10.0.0.1!", "", ""), (2, "nothing", "", ""), (3, None, "", ""), (3, "x +49 30 1234567", "", ""),
            (None, "a@b.cd", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = pii.mask_pii(df)
    assert out.columns == df.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == [
        ("1", "é mail [EMAIL] or [IP]!"), ("2", "nothing"), ("3", "None"), ("3", "x [PHONE]"), ("None", "[EMAIL]")]
    assert pii.mask_pii(df.limit(0)).count() == 0 and pii.find_pii(df.limit(0)).count() == 0


def test_em_trusts_labelers_that_agree():
    counts = [{"kind": "phone", "n": 500, "v0": 0, "v1": 1, "v2": 1, "v3": 0, "v4": 1},
              {"kind": "phone", "n": 400, "v0": 0, "v1": 0, "v2": 0, "v3": -1, "v4": -1},
              {"kind": "phone", "n": 5, "v0": 0, "v1": 0, "v2": 1, "v3": -1, "v4": -1}]
    p = pii.reliabilities(counts)
    assert p["phone:0,1,1,0,1"] > 0.9 and p["phone:0,0,0,-1,-1"] < 0.1


def test_mask_helper_names_may_clash(spark):
    from quarry.llm.pii import mask_pii
    names = ["spans", "last_end", "doc_key", "text_key", "_spans", "_last", "_d", "_th"]
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    rows = [(1, "write to ann@example.org now", *"abcdefgh"), (2, None, *"ijklmnop")]
    out = mask_pii(spark.createDataFrame(rows, schema)).orderBy("doc_id").collect()
    assert [tuple(r) for r in out] == [(1, "write to [EMAIL] now", *"abcdefgh"), rows[1]]
