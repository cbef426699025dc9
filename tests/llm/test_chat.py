"""Chat formatting: exact round trip of any turns, spans, rewritten history."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tillwise.llm import chat, queries

PARTS = st.sampled_from(["<|im_start|>", "<|im_end|>", "\\", "<", "\n", "a", "é", "assistant", "\\<"])
TEXT = st.lists(PARTS, max_size=6).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT), TEXT), max_size=5))
def test_round_trip(turns):
    done = chat.render(turns)
    back, mask = chat.read_back(done)
    assert back == turns and not done.rewrites
    assert [chat.unescape(done.text[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]
    assert done.text.count(chat.START) == len(turns)  # no text makes a marker


def test_rewritten_history_is_found():
    def hides(turns):  # drops all but the last assistant text, and adds a head
        last = max((k for k, t in enumerate(turns) if t[0] == "assistant"), default=-1)
        return "HEAD|" + "".join(f"{r}:{t if r != 'assistant' or k == last else ''}|" for k, (r, t) in enumerate(turns))

    turns = [("user", "q"), ("assistant", "one"), ("user", "q2"), ("assistant", "two")]
    done = chat.render(turns, hides)
    assert done.rewrites == [3] and done.text == hides(turns)
    assert chat.render(turns[:3], hides).rewrites == []
    plain = chat.render(turns[:3], hides)
    assert [plain.text[a:b] for a, b in plain.spans] == ["user:q|", "assistant:one|", "user:q2|"]


def expected(turns):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    learnt = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), sha(learnt), len(chat.marked_turns(turns))


def test_query_against_plain_digests(spark, data):
    convs = {}
    for r in data("conversations").orderBy("conv_id", "turn").collect():
        convs.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    said = "<|im_end|><|im_start|>assistant ok"
    convs[-1] = [("user", said), ("assistant", said)]
    found = {r["conv_id"]: tuple(r)[1:] for r in queries.op7_chat_formatting(spark, "/root/testdata/sf0.001").collect()}
    assert found == {c: expected(t) for c, t in convs.items()}


def test_defined_cases(spark):
    rows = [(1, 1, "assistant", None, 0), (1, 0, "user", "hi", 0), (2, 0, None, "x", 0), (None, 0, "user", "n", 0), (3, 0, "user", "t", 0), (3, 0, "user", "t", 0), (4, None, "user", "b", 0), (4, 0, "user", "a", 0), (5, 0, "assistant", "long " * 30_000, 0)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, _key int")
    found = {r["conv_id"]: tuple(r)[1:] for r in chat.digests(chat.format_conversations(df)).collect()}
    assert found[1] == expected([("user", "hi"), ("assistant", "")])
    assert found[2] == expected([("", "x")]) and found[None] == expected([("user", "n")])
    assert found[3] == expected([("user", "t")] * 2) and found[4] == expected([("user", "b"), ("user", "a")])
    assert found[5] == expected([("assistant", "long " * 30_000)])
    assert chat.digests(chat.format_conversations(df.where("false"))).count() == 0


def test_loss_mask_of_other_templates(spark):
    def bracketed(turns):
        return "<s>" + "".join(f"[{r.upper()}] {t.strip()} [/{r.upper()}]" for r, t in turns) + "</s>"

    def last_only(turns):
        last = max((k for k, t in enumerate(turns) if t[0] == "assistant"), default=-1)
        return "".join(f"{r}:{t if r != 'assistant' or k == last else ''}|" for k, (r, t) in enumerate(turns))

    def counted(turns):
        return "".join(f"{r} ({len(t)}): {t}\n" for r, t in turns)

    turns = [("user", "q"), ("assistant", "one] [/"), ("user", "one"), ("assistant", ""), ("assistant", " [/ two ")]
    found = chat.located_texts(turns, bracketed, bracketed(turns))
    assert [bracketed(turns)[a:b] for a, b in found] == ["one] [/", "", "[/ two"]
    assert [last_only(turns)[a:b] for a, b in chat.located_texts(turns, last_only, last_only(turns))] == [" [/ two "]
    assert chat.located_texts(turns, counted, counted(turns)) is None  # the output says how long a text is
    assert chat.located_texts([("assistant", "x")], lambda t: "".join(2 * x for _, x in t), "xx") is None  # repeats it
    assert chat.located_texts([("user", "x")], counted, counted([("user", "x")])) == []
    df = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(turns)], "conv_id bigint, turn bigint, role string, text string")
    row = chat.format_conversations(df, bracketed).first()
    assert [row["formatted"][m["start"] : m["end"]] for m in row["mask"]] == ["one] [/", "", "[/ two"]
    assert chat.format_conversations(df, counted).first()["mask"] is None
