"""Repeats that stand on fewer lines than a window."""

from vellum.llm import line_dedup

LONG = " ".join(f"word{i}" for i in range(60))
HALF = [" ".join(f"{x}{i}" for i in range(30)) for x in "ab"]


def run(frame, rows, **kw):
    return {r.doc_id: (r.n_lines, r.n_removed, r.n_runs, r.text) for r in line_dedup.drop_repeated_runs(frame(rows), **kw).collect()}


def test_copies_on_one_and_two_lines_and_long_passages(frame):
    rows = [
        (1, LONG), (2, " " + LONG), (3, "\n".join(HALF)), (4, "\n\n".join(HALF)), (5, HALF[0]),
        (6, f"own head\n{LONG}\nown middle\nown end\n{HALF[0]}\n{HALF[1]}\nlast"), (7, "a\nb\nc"), (8, "x\na\nb\nc"), (None, "first\n" + LONG),
    ]
    got = run(frame, rows)
    assert got[None] == (2, 0, 0, "first\n" + LONG)
    assert got[1] == (1, 1, 1, "") and got[2] == (1, 1, 1, "")
    assert got[3] == (2, 0, 0, rows[2][1]) and got[4] == (3, 2, 1, "") and got[5] == (1, 0, 0, HALF[0])
    assert got[6] == (7, 3, 2, "own head\nown middle\nown end\nlast")
    assert got[7] == (3, 0, 0, "a\nb\nc") and got[8] == (4, 3, 1, "x")


def test_short_documents_as_one_window(frame):
    rows = [(1, "a line"), (2, "a line "), (3, "p\nq"), (4, "p\n\nq"), (5, "a line\nother\nthird"), (6, ""), (7, ""), (8, None)]
    got = run(frame, rows, short=True)
    assert {i: r[1] for i, r in got.items()} == {1: 0, 2: 1, 3: 0, 4: 2, 5: 0, 6: 0, 7: 0, 8: 0}
    assert {i: r[1] for i, r in run(frame, rows, short=True, words=None).items()} == {i: r[1] for i, r in got.items()}
    assert all(r[1] == 0 for r in run(frame, rows).values())


def test_many_removed_lines_of_a_long_document(frame):
    """Over 5,000 lines, a very long line, all of it repeated."""
    text = "\n".join([f"line {i} of the long one" for i in range(20_000)] + [LONG * 2000])
    got = run(frame, [(1, text), (2, text), (3, "\n".join(text.split("\n")[::2]))])
    assert got[1] == (20_001, 0, 0, text) and got[2] == (20_001, 20_001, 1, "")
    assert got[3] == (10_001, 1, 1, "\n".join(text.split("\n")[:20_000:2]))
