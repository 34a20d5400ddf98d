import hashlib
import random

import pytest

from hearthlake.llm import chat, decontaminate
from tests.llm.helpers import frame, rows_of


def turns_frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments int, formatted string")


def test_marked_texts_come_back(spark):
    r = random.Random(1)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[TURN]", "[TEXT]", "[/TURN]", "\\", "\\\\", "[", "<", "é漢", " ", "\n", "x", "$1"]
    rows = []
    for conv in range(60):
        for turn in range(r.randint(1, 6)):
            role = r.choice(["user", "assistant", "system", "tool", "[TEXT]", None, ""])
            rows.append((conv, turn, role, "".join(r.choice(bits) for _ in range(r.randint(0, 8))) if r.random() < 0.9 else None, 1, "f"))
    rows += [(None, 0, "user", "a", 1, "f"), (None, None, "assistant", "b", 1, "f"), (70, 1, "user", "tie", 1, "f"), (70, 1, "user", "tie", 1, "f"), (71, 0, "user", "long " * 20000, 1, "f")]
    chats = chat.format_chats(turns_frame(spark, rows))
    found = rows_of(chat.digests(chats), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    want = []
    for conv in {x[0] for x in rows}:
        own = sorted(((-1 if x[1] is None else x[1], x[2] or "", x[3] or "") for x in rows if x[0] == conv))
        loss = "".join(t for _, role, t in own if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for _, role, t in own)
        want.append((conv, len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    assert found == sorted(want, key=str)


@pytest.mark.parametrize(
    "roles, state",
    [(["user", "assistant"], "answered"), (["system", "user", "assistant", "user"], "asked"), (["assistant"], "invalid"), (["user", "user"], "invalid"), (["user", "assistant", "system"], "invalid"), (["system"], "briefed")],
)
def test_role_machine(spark, roles, state):
    rows = [(1, n, role, "t", 1, "f") for n, role in enumerate(roles)]
    found = chat.format_chats(turns_frame(spark, rows)).first()
    assert (found.state, found.valid) == (state, state == "answered")


def test_loss_flags_and_own_template(spark):
    template = chat.Template(roles={"q": chat.Turn("<q>", "</q>"), "a": chat.Turn("<a>", "</a>", loss=True)}, moves={("start", "q"): "x", ("x", "a"): "answered"})
    found = chat.format_chats(turns_frame(spark, [(1, 0, "q", "<a>?", 1, "f"), (1, 1, "a", "yes", 1, "f")]), template).first()
    assert found.formatted == "<q><\\a>?</q><a>yes</a>" and found.valid
    assert [(s.text, s.loss) for s in found.segments if s.loss] == [("yes", True)]
    assert chat.format_chats(turns_frame(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = chat.digests(chat.format_chats(turns_frame(spark, [(1, 0, "user", "a", 1, "f")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_distance(pattern, text):
    last = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
        last = row
    return min(last)


def test_bit_parallel_distance():
    r = random.Random(1)
    for _ in range(300):
        text, pattern = ("".join(r.choice("abc") for _ in range(r.randint(low, high))) for low, high in ((0, 40), (1, 15)))
        want = plain_distance(pattern, text)
        assert decontaminate.best_match(pattern, text, want) == want
        assert decontaminate.best_match(pattern, text, want - 1) is None
    assert decontaminate.best_match("", "abc", 0) == 0


@pytest.mark.parametrize("block_chars", [100, 10**6])
def test_finds_edited_items_and_nothing_else(spark, block_chars):
    r = random.Random(7)
    item = lambda: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(20))
    items = [(i, item()) for i in range(6)] + [(6, None), (7, ""), (8, "too  short"), (9, "a"), (None, item()), (None, "no id")]
    docs = [(n, f"{item()} {item()}") for n in range(20)]
    for n in range(40):
        chars = list(items[n % 6][1])
        for _ in range(r.randint(0, int(len(chars) * 0.09))):
            chars[r.randrange(len(chars))] = r.choice("abcdefghijXY")
        docs.append((100 + n, f"{item()}\n{''.join(chars).upper()}  {item() * (n % 3)}"))
    docs += [(210, "Too\nShort"), (211, "it is too short, a"), (212, "too shortened"), (213, "x too short"), (214, "has no id"), (215, "has no idea"), (216, items[10][1])]
    docs += [(200, None), (201, ""), (202, items[0][1]), (202, items[0][1]), (None, items[1][1]), (203, " ".join(t for _, t in items[:3]))]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items + items[:1]], "item_id long, text string, doc_id string")
    want = []
    for d, t in docs:
        for i, p in items:
            p, t = decontaminate.normal(p), decontaminate.normal(t)
            short = len(p) < decontaminate.LEAST_CHARS
            n = plain_distance(p, t) if p and not short else 0 if p and f" {p} " in f" {t} " else None
            if n is not None and n <= int(len(p) * decontaminate.ERROR_RATE):
                want.append((d, i, n, short))
    found = decontaminate.find(frame(spark, docs), benchmark, block_chars=block_chars)
    assert rows_of(found, "doc_id", "item_id", "distance", "short") == sorted([w for w in want if w[1] is not None], key=str)
    leaked = {d for d, *_ in want}
    kept = decontaminate.clean(frame(spark, docs), benchmark, block_chars=block_chars)
    assert kept.columns == frame(spark, docs).columns
    assert rows_of(kept, "doc_id") == sorted(((d,) for d, _ in docs if d not in leaked), key=str)


def test_empty_sides(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a benchmark item that is long enough to search")], "item_id long, text string")
    docs = frame(spark, [(1, "a benchmark item that is long enough to search"), (2, None)])
    assert decontaminate.find(docs, none).count() == 0 and decontaminate.clean(docs, none).count() == 2
    assert decontaminate.find(frame(spark, []), some).count() == 0
    assert rows_of(decontaminate.clean(docs, some), "doc_id") == [(2,)]
