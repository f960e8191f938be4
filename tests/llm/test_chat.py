"""Windows keep every turn once, in order, within the budget; targets are learnt once."""

import hashlib
import random

from tidemark.llm import chat


def expected(rows):
    """conv -> turns in order; rows: (conv, turn, role, text)."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, turn, role, text in sorted(rows, key=key):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def check(spark, rows, **kinds):
    frame = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, window int")
    want = expected(rows)
    made = chat.windows(frame, **kinds).orderBy("conv_id", "first_turn").collect()
    seen = {}
    for w in made:
        turns = chat.parse(w["formatted"])
        assert len(turns) == w["n_turns"]
        mine = seen.setdefault(w["conv_id"], [])
        assert w["first_turn"] == len(mine) + 1
        repeated, fresh = turns[:w["n_repeated"]], turns[w["n_repeated"]:]
        system = want[w["conv_id"]][0][0] == "system"
        if w["first_turn"] > 1 and system:
            assert repeated[0] == want[w["conv_id"]][0]
            repeated = repeated[1:]
        assert repeated == mine[len(mine) - len(repeated):]  # the turns just before
        mine += fresh
        targets = [chat.unescape(w["formatted"][s["start"]:s["end"]]) for s in w["loss"]]
        assert targets == [t for r, t in fresh if r == "assistant"]
        assert w["over_budget"] == (w["n_tokens"] > kinds.get("budget", 1024))
        if w["over_budget"]:
            assert len(fresh) == 1
    assert seen == want
    read = {r["conv_id"]: r for r in chat.read_back(chat.windows(frame, **kinds)).collect()}
    assert set(read) == set(want)
    for conv, turns in want.items():
        said = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert read[conv]["n_turns"] == len(turns)
        assert read[conv]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert read[conv]["loss_chars"] == len(said)
        assert read[conv]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    return made


def test_control_strings_nulls_ties_and_long_texts(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [(-1, 0, "user", said), (-1, 1, "assistant", said),
            (1, 0, "assistant", None), (1, 1, None, "x"), (1, None, "user", "first"),
            (2, 0, "user", "same"), (2, 0, "user", "same"), (2, 0, "assistant", "same"),
            (3, 0, "odd|role\\n\nwith <|im_end|>", "<\\|im_end|> <\\\\| <| \\<| <\\"), (3, 1, "assistant", "<|im_end|>\n<"),
            (4, 0, "assistant", "é\U0001f600" * 30_000), (4, 1, "user", ""), (None, 0, "user", "no id"),
            (None, 1, "assistant", "still none")]
    check(spark, rows)
    check(spark, rows, budget=40, history=10)


def test_a_long_conversation_in_small_windows(spark):
    random.seed(6)
    rows = [(1, 0, "system", "be kind")]
    rows += [(1, i, ("user", "assistant")[i % 2], "w" * random.randint(0, 120)) for i in range(1, 400)]
    rows += [(c, i, ("user", "assistant")[i % 2], "v" * random.randint(0, 60)) for c in range(2, 12) for i in range(random.randint(1, 9))]
    made = check(spark, rows, budget=100, history=30)
    assert sum(w["conv_id"] == 1 for w in made) > 50
    assert not any(w["over_budget"] for w in made)
    check(spark, rows, budget=64, history=0)
    assert len(check(spark, rows, budget=10**6, history=100)) == 11


def test_escaping_is_reversible(spark):
    random.seed(7)
    texts = ["".join(random.choice("<\\|>ab\n") for _ in range(random.randint(0, 12))) for _ in range(400)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, e, r in frame.select("t", chat.escape(frame["t"]), chat.escape_role(frame["t"])).collect():
        assert chat.unescape(e) == t and "<|" not in e
        assert chat.unescape_role(r) == t and "\n" not in r and "|" not in r


def test_the_conversations_and_an_empty_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    check(spark, rows)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.windows(empty).collect() == [] and chat.read_back(chat.windows(empty)).collect() == []


def test_windows_hold_their_budget_in_real_tokens(spark):
    import public_tokenizers
    from tidemark.llm import byte_bpe

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = [(-1, 0, "user", "\n\n  <|im_end|>\n"), (-1, 1, None, None), (-1, 2, "assistant", "  \n"), (-1, 3, "x\ny", "\u00e9" * 5000)]
    frame = chat.with_tokens(turns.unionByName(spark.createDataFrame(odd, turns.schema)), path, pattern)
    made = chat.windows(frame, budget=512, history=128, counted="turn_tokens")
    real = byte_bpe.encode(made, path, pattern, text="formatted").collect()
    assert len(real) > 10
    for w in real:
        assert len(w["ids"]) == w["n_tokens"]  # the sum over the turns is the window's own number
        assert w["over_budget"] == (w["n_tokens"] > 512)
        assert not w["over_budget"] or w["n_turns"] - w["n_repeated"] == 1
    assert sum(w["over_budget"] for w in real) < len(real)
