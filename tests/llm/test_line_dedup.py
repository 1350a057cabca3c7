import random

from quarry.llm.line_dedup import dedup_lines

SCHEMA = "doc_id long, text string, line string, h string"


def close(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, least=20):
    blank = " \t\r\x0b\x0c"
    place = {}
    for d, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            if line.strip(blank):
                place[line] = min(place.get(line, (d, i)), (d, i))
    near = {b for b in place for a in place if place[a] < place[b] and min(len(a), len(b)) >= least and close(a, b)}
    out = {}
    for d, t in rows:
        if t is None:
            out[d] = None
            continue
        keep = [(x, bool(x.strip(blank))) for i, x in enumerate(t.split("\n"))
                if not x.strip(blank) or (x not in near and place[x] == (d, i))]
        if len(keep) == t.count("\n") + 1 or any(r for _, r in keep):
            out[d] = "\n".join(x for x, _ in keep)
    return out


def edited(rnd, line):
    i = rnd.randrange(len(line))
    return rnd.choice([line[:i] + line[i + 1:], line[:i] + "ü" + line[i:], line[:i] + "q" + line[i + 1:]])


def test_equals_brute_force(spark):
    rnd = random.Random(5)
    pool = ["".join(rnd.choice("ab ") for _ in range(rnd.choice([5, 19, 20, 21, 22, 40]))) for _ in range(60)]
    rows = []
    for d in range(80):
        lines = []
        for _ in range(rnd.randrange(1, 8)):
            line = rnd.choice(pool)
            while rnd.random() < 0.4 and len(line) > 1:
                line = edited(rnd, line)
            lines.append(rnd.choice([line, "", "  "]) if rnd.random() < 0.2 else line)
            if rnd.random() < 0.5:
                pool.append(line)
        rows.append((d, "\n".join(lines)))
    rows += [(90, None), (91, ""), (92, "\n\n"), (93, "one license line of many words")] + \
            [(100 + i, "one license line of many words") for i in range(40)]
    rows += [(200 + i, f"page {i % 10} of the very long report of the year") for i in range(30)]
    rows.append((300, "x" * 50000 + "\n" + "x" * 50001 + "\n" + "y" * 70))
    df = spark.createDataFrame([r + ("a", "b") for r in rows], SCHEMA).repartition(5)
    out = dedup_lines(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == plain(rows)


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "same line here\nsame line here", "", ""), (None, None, "", "")] + [(4, "same line here", "", "")] * 2
    out = dedup_lines(spark.createDataFrame(rows, SCHEMA))
    assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == [
        ("4", "same line here"), ("4", "same line here"), ("None", "None"), ("None", "same line here\nsame line here")]
    assert dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_helper_names_may_clash(spark):
    names = ["gone_id", "gone_lines", "new_text", "_gone", "_text", "GONE", "key", "own"]
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    rows = [(1, "a line of twenty letters\nother", *"abcdefgh"), (2, "a line of twenty letters\nsome more", *"ijklmnop")]
    out = dedup_lines(spark.createDataFrame(rows, schema)).orderBy("doc_id").collect()
    assert [tuple(r) for r in out] == [rows[0], (2, "some more", *"ijklmnop")]


def test_group_of_near_copies_emits_few_rows():
    """2,000 lines that share a half and differ by a word: rows in proportion to segments, and no pair lost."""
    import pandas as pd

    from quarry.llm import line_dedup as L
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(7)) for _ in range(60)]
    lines = set()
    while len(lines) < 2000:
        w = words[:]
        w[rnd.randrange(30, 60)] = "".join(rnd.choice("ijklmnop") for _ in range(7))
        lines.add(" ".join(w))
    lines = sorted(lines)
    lines += [edited(rnd, lines[i]) for i in range(0, 2000, 100)]
    pdf = pd.DataFrame({"line": lines, "h": range(len(lines))})
    keys = pd.concat(L._segment_keys([pdf]))
    assert len(keys) <= len(lines) * 2 * (480 // L.SEGMENT + 2)
    both = keys.groupby("key").h.nunique()
    keys = keys[keys.key.isin(both[both > 1].index)]
    pick = lambda longer: [sorted(set(keys.segment[(keys.h == h) & (keys.longer == longer)])) for h in range(len(lines))]
    variants = pd.concat(L._variants([pdf.assign(own=pick(0), longer=pick(1))]))
    assert len(variants) <= len(lines) * 3 * L.SEGMENT  # 2 x 480 a line before
    met = set()
    for _, g in variants.groupby("key"):
        met |= {(min(a, b), max(a, b)) for a in g.h for b in g.h if a != b and len(g) < 50}
    for i in range(0, 2000, 100):
        if close(lines[i], lines[2000 + i // 100]) and lines[i] != lines[2000 + i // 100]:
            assert (i, 2000 + i // 100) in met
