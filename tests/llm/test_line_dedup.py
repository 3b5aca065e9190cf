from tidemark.llm import line_dedup

from .conftest import frame

P = "p1 x\np2 x\np3 x\np4 x"
ROWS = [
    (None, "n1\nn2\nn3"), (1, P), (2, "own a\n" + P + "\nown b"), (3, "p2 x\np3 x"), (4, None), (5, ""), (6, "\n\n\n\n\n\n"),
    (7, "a\na\na\na\na"), (8, P), (8, P), (9, "n1\nn2\nn3\nlast"), (10, "z\n\n\n\n"), (11, "z\n\n\n"),
    (12, "\n".join(f"l{i}" for i in range(30000))), (13, "q\n" + "\n".join(f"l{i}" for i in range(30000))),
]


def plain(rows):
    """Kept text of each different (id, text), by looking at every window in order."""
    seen, out = set(), {}
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines, gone = (t or "").split("\n"), set()
        for i in range(len(lines) - 2):
            w = tuple(lines[i : i + 3])
            if not "".join(w).strip():
                continue
            if w in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(w)
        out[d, t] = t if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)
    return out


def test_against_every_window(spark):
    rows = line_dedup.repeated_lines(frame(spark, ROWS)).collect()
    want = plain(ROWS)
    assert len(rows) == len(ROWS)
    for r in rows:
        assert (r.kept_text, r.n_removed) == want[r.doc_id, r.text]
        assert r.n_lines == (0 if r.text is None else r.text.count("\n") + 1)


def test_removals_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", -1)
    monkeypatch.setattr("tidemark.llm.common.BROADCAST_BYTES", -1)
    rows = line_dedup.repeated_lines(frame(spark, ROWS)).collect()
    want = plain(ROWS)
    assert sorted((repr(r.doc_id), r.n_removed) for r in rows) == sorted((repr(d), want[d, t][1]) for d, t in ROWS)


def test_drop_keeps_columns_and_originally_empty_texts(spark):
    docs = frame(spark, ROWS)
    kept = line_dedup.drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    got = sorted(repr(r.doc_id) for r in kept.collect())
    assert got == sorted(repr(d) for d in [None, 1, 2, 3, 4, 5, 6, 7, 9, 10, 12, 13])


def test_native_plan(spark):
    plan = line_dedup.repeated_lines(frame(spark, ROWS[:4]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert line_dedup.repeated_lines(frame(spark, [])).collect() == []
    assert line_dedup.drop_repeated_lines(frame(spark, [])).collect() == []
