import re

from tidemark.llm import quality

from .conftest import frame

TWENTY = " ".join(f"the word{i} of" for i in range(10))
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, TWENTY), (5, TWENTY + "\n" + TWENTY), (6, "a b c d e f g h " * 40),
    (7, "one two\x0bthree\x0cfour # * | <>\nx\n\nx\n y"), (8, "# ! " + TWENTY + " #" * 50), (None, TWENTY),
    (9, "É a   b"), (4, TWENTY), (10, "w " * 20000), (11, " ".join(f"v{i}" for i in range(20000))),
    (12, "a b c d e f g h i a b c d e f g h"), (13, "EN!! DE!! " + TWENTY.replace(" ", "!! ")),
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = {}
    for r in runs:
        count[r] = count.get(r, 0) + 1
    covered = {i + k for i, r in enumerate(runs) if count[r] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    counts = (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    return counts + (n < 20 or 100 * len(covered) > 30 * n,)


def test_counts_against_plain_python(spark):
    rows = quality.quality(frame(spark, ROWS)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = sorted((repr(r.doc_id), tuple(r[n] for n in names)) for r in rows)
    assert got == sorted((repr(d), plain(t)) for d, t in ROWS)


def test_verdicts(spark):
    rows = {r.doc_id: r for r in quality.quality(frame(spark, ROWS)).collect()}
    assert rows[4].kept and rows[None].kept and rows[4].failed == []
    assert not rows[8].kept and "symbols" in rows[8].failed
    assert "shouting" in rows[13].failed
    assert not any(rows[d].kept for d in (1, 2, 3, 5, 6, 7, 10, 11))


def test_own_table_of_thresholds(spark):
    rules = (quality.Rule("short", "n_words", None, 25),)
    rows = {r.doc_id: r for r in quality.quality(frame(spark, ROWS), rules).collect()}
    assert rows[4].failed == ["short"] and rows[1].failed == []


def test_one_native_projection(spark):
    plan = quality.quality(frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert quality.quality(frame(spark, [])).collect() == []
