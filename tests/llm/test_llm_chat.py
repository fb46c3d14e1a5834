"""Chat parsing: Viterbi against all paths, chunks against the whole, held-out roles, edges."""

from itertools import product

import numpy as np
import pytest
from llm_tables import write

from tidemark.llm import chat
from tidemark.llm.queries import op6_chat


def random_model(rng, n=4):
    return np.log(rng.dirichlet(np.ones(n))), np.log(rng.dirichlet(np.ones(n), n))


def test_best_path_of_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(20):
        start, move = random_model(rng)
        lines = np.log(rng.random((5, 4)))
        value = lambda p: start[p[0]] + sum(lines[t, s] for t, s in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:]))  # noqa: E731,B023
        assert tuple(chat.best_path(start, move, lines)) == max(product(range(4), repeat=5), key=value)


def test_chunks_give_the_whole_path():
    rng = np.random.default_rng(1)
    for _ in range(20):
        start, move = random_model(rng)
        lines = np.log(rng.random((23, 4)))
        cuts = np.split(lines, [4, 5, 15])
        ends = chat.chunk_ends(start, move, [chat.chunk_product(move, c) for c in cuts])
        parts = [chat.best_path(e, move, c, r) for (e, r), c in zip(ends, cuts)]
        assert (np.concatenate(parts) == chat.best_path(start, move, lines)).all()


@pytest.mark.parametrize(
    "line,kind",
    [("User: hi", 2), ("### Assistant: x", 3), ("[system] be brief", 1), ("<|user|> q", 2), ("**AI:** yes", 3), ("Alice: hello", 4), ("no marker here", 0), ("", 0)],
)
def test_markers(line, kind):
    assert chat.marker_of(line)[0] == kind


def test_held_out_roles(spark):
    rows = op6_chat(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").count()
    held = [r for r in rows if r.held_out]
    assert sum(r.right_lines for r in held) >= 0.97 * sum(r.n_lines for r in held)
    whole = [r for r in held if r.right_lines == r.n_lines and r.rendered.count("<|end|>") == 1]
    assert len(whole) >= 0.85 * len(held)
    assert sum(r.rendered.startswith(f"<|{r.role}|>") for r in whole) >= 0.97 * len(whole)  # others go on with a turn taken for theirs


def test_long_conversation_in_chunks(spark, monkeypatch):
    turns = [(1, t, ("user", "assistant")[t % 2], f"{'Why so' if t % 2 == 0 else 'Because it is'} {t}{'?' if t % 2 == 0 else '. ' * 40}") for t in range(60)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    model = chat.fit(chat.as_transcripts(df))
    rows = chat.as_transcripts(df).selectExpr("turn row", "conv_id key", "turn pos", "text")
    whole = {r.row: (r.roles, r.rendered) for r in chat.parse_transcripts(rows, model).collect()}
    monkeypatch.setattr(chat, "CHUNK_ROWS", 7)
    assert {r.row: (r.roles, r.rendered) for r in chat.parse_transcripts(rows, model).collect()} == whole
    assert all(whole[t][0] == [role] for _, t, role, _ in turns)


def plain(rows, model):
    """(row -> roles, rendered) of whole transcripts, one line after the other; rows are (row, key, pos, text)."""
    out, keys = {}, {}
    for row, key, pos, text in rows:
        keys.setdefault(key, []).append((pos is not None, pos or 0, text or "", row))
    for texts in keys.values():
        lines = [(row, line, seen) for _, _, text, row in sorted(texts) for line, seen in chat.observed(text)]
        score, back = [], []
        for t, (_, _, seen) in enumerate(lines):
            emit = [sum(model.emit[f][s, v] for f, v in enumerate(seen)) for s in range(len(chat.STATES))]
            came = [max(range(len(emit)), key=lambda q: score[-1][q] + model.move[q, s]) if t else -1 for s in range(len(emit))]
            score.append([(score[-1][came[s]] + model.move[came[s], s] if t else model.start[s]) + emit[s] for s in range(len(emit))])
            back.append(came)
        path = [max(range(len(chat.STATES)), key=score[-1].__getitem__)] if lines else []
        for came in back[:0:-1]:
            path.insert(0, came[path[0]])
        for _, _, _, row in texts:
            out[row] = ([], "")
        for t, (row, line, _) in enumerate(lines):
            role, opens = chat.STATES[path[t]]
            roles, rendered = out[row]
            if opens:
                rendered += ("\n" if rendered else "") + f"<|{chat.ROLES[role]}|>"
                line = line[chat.marker_of(line)[1] :]
            elif rendered:
                rendered += "\n"
            closes = "<|end|>" if t + 1 == len(lines) or chat.STATES[path[t + 1]][1] else ""
            out[row] = ([*roles, chat.ROLES[role]], rendered + chat._TAG.sub("&lt;", line) + closes)
    return out


@pytest.mark.parametrize("chunk", [3, 1024])
def test_query_rows_against_plain_code(spark, monkeypatch, chunk):
    """Whole conversations of sf0.001, also cut into chunks of three rows."""
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").selectExpr("monotonically_increasing_id() row", "*")
    texts = chat.as_transcripts(turns)
    model = chat.fit(texts)
    rows = texts.selectExpr("row", "conv_id key", "turn pos", "text").collect()
    monkeypatch.setattr(chat, "CHUNK_ROWS", chunk)
    df = spark.createDataFrame(rows, "row long, key long, pos long, text string")
    assert {r.row: (r.roles, r.rendered) for r in chat.parse_transcripts(df, model).collect()} == plain([tuple(r) for r in rows], model)


def test_turns_that_run_over_cuts_and_rows_without_order(spark, monkeypatch):
    """A row per line: a turn of many lines, null keys, null and repeated positions give the same at any cut."""
    lines = ["User: first", *[f"goes on {i:02d}" for i in range(9)], "Assistant: answer", *[f"and on {i:02d}" for i in range(20)]]
    rows = [(i, 1, i, line) for i, line in enumerate(lines)] + [(100 + i, None, 5, f"same place {i:02d}") for i in range(15)]
    rows += [(200 + i, None, None, f"no place {i:02d}") for i in range(15)] + [(300 + i, 2, 0, "again") for i in range(8)] + [(400, 1, 4, "   ")]
    turns = [(1, t, ("user", "assistant")[t % 2], "\n".join(f"line {i}" for i in range(6))) for t in range(10)]
    model = chat.fit(chat.as_transcripts(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")))
    df = spark.createDataFrame(rows, "row long, key long, pos long, text string").repartition(3)
    want = plain(rows, model)
    assert sum(r.count("<|end|>") for _, r in want.values()) < 30  # most lines go on
    for chunk in (1024, 4, 1):
        monkeypatch.setattr(chat, "CHUNK_ROWS", chunk)
        monkeypatch.setattr(chat, "RANGE_ROWS", 7)
        assert {r.row: (r.roles, r.rendered) for r in chat.parse_transcripts(df, model).collect()} == want


def test_edges(spark, tmp_dir):
    turns = [
        (1, 0, "user", "hi <|end|> there"), (1, 1, "assistant", None), (1, 1, "assistant", ""), (1, None, "user", "no turn"), (None, 0, "user", "no id"),
        (2, 0, None, "no role"), (2, 1, "robot", "other role"), (3, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "user", "\n \n"), (5, 0, "user", "x\n" * 30_000),
    ]
    rows = op6_chat(spark, write(tmp_dir, conversations=turns)).collect()
    assert sorted(str((r.conv_id, r.turn, r.role)) for r in rows) == sorted(str(t[:3]) for t in turns)
    empty = [r for r in rows if r.n_lines == 0]
    assert empty and all(r.rendered == "" and r.right_lines == 0 for r in empty)
    assert any(r.n_lines == 0 for r in rows if (r.conv_id, r.turn) == (1, 1))  # a null text has no marker either
    assert all("hi <|end|>" not in r.rendered for r in rows)
    assert op6_chat(spark, write(tmp_dir)).collect() == []
