from collections import defaultdict

from civicspark.llm.line_dedup import dedup_lines

from .conftest import documents

STRIP = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line).strip(STRIP)


def brute(rows, least, chars=1):
    seen = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            seen[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= chars and len(seen[key(x)]) >= least)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept) if len(kept) < len(lines) else text))
    return sorted(out, key=repr)


ROWS = [
    (1, "Same line\nown\nSAME LINE\n"), (2, "\tsame line \nother\n\n"), (3, "same line\r\nÉ\né"), (4, None), (5, ""), (6, "\n\n"), (None, "same line\nx"),
    (None, "x\nthird"), (7, "É\nx"), (7, "É\nx"), (7, "own\nx"), (8, "long " * 30000 + "\nsame line\n" + "y\n" * 5000),
]


def test_equals_brute_force_with_odd_rows(spark):
    for least, chars in ((2, 1), (3, 1), (2, 2)):
        out = dedup_lines(documents(spark, ROWS), least, chars)
        assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()), key=repr) == brute(ROWS, least, chars)


def test_other_columns_stay(spark):
    out = dedup_lines(documents(spark, ROWS), 2)
    assert set(documents(spark, ROWS).columns) == set(out.columns) - {"n_dropped"}
    assert {r["key"] for r in out.collect()} == {"k"}


def test_empty_table(spark, empty):
    assert dedup_lines(empty).count() == 0
