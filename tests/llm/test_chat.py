import hashlib

from hypothesis import given, settings, strategies as st

from pressmill.llm.chat import CONTROLS, chat_format, escape, format_chats, read_chats, tokenizer, unescape, VOCABULARY

PIECES = st.lists(st.sampled_from(CONTROLS + ("\\", "<", "[", "/s>", "é", " ", "\n", "|")) | st.text(max_size=3), max_size=12)


@settings(max_examples=500, deadline=None)
@given(PIECES)
def test_escape_is_reversible_and_leaves_no_control_string(parts):
    text = "".join(parts)
    out = escape(text)
    assert unescape(out) == text
    assert not any(c in out for c in CONTROLS)


@settings(max_examples=200, deadline=None)
@given(PIECES)
def test_ids_give_the_text_back(parts):
    text, coder = escape("".join(parts)), tokenizer(VOCABULARY)
    ids = coder.encode(text, add_special_tokens=False).ids
    assert coder.decode(ids, skip_special_tokens=False) == text
    assert all(i < coder.get_vocab_size() for i in ids)


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0]))
        loss = "".join(t for _, r, t in turns if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        out[conv] = (len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def got(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_edges(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a<|done|>b"), (1, None, None, "x"), (None, 0, "assistant", ""),
            (2, 0, "assistant", "<\\|done|>"), (2, 1, "assistant", "long " * 20_000), (2, 2, "<|turn|>", "😀".encode("utf-16", "surrogatepass").decode("utf-16"))]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "1 as position", "2 as token_ids")
    assert got(read_chats(format_chats(df))) == expected(rows)
    assert read_chats(format_chats(df.limit(0))).count() == 0


def test_formatted_chars(spark):
    """Marks, and roles and texts as they are written, escapes included."""
    rows = [(1, 0, "user", "a</s>b"), (1, 1, "assistant", "ć😀"), (2, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    marks = len("<|turn|><|says|><|done|>")
    shown = {r.conv_id: r.formatted_chars for r in read_chats(format_chats(df)).collect()}
    assert shown == {1: 2 * marks + len("user") + len("a<\\/s>b") + len("assistant") + 2, 2: marks}


def test_places_and_ties(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = format_chats(df).orderBy("position").collect()
    assert [r.role for r in out] == ["assistant", "user", "user"]
    assert [r.first_token for r in out] == [0, out[0].n_tokens, out[0].n_tokens + out[1].n_tokens]
    base = tokenizer(VOCABULARY).get_vocab_size()
    ids, mask = out[0].token_ids, out[0].loss_mask
    assert len(ids) == len(mask) and mask.index(True) == ids.index(base + 1) + 1 and mask[::-1].index(True) == 1 and ids[-1] == base + 2
    assert not any(out[1].loss_mask) and len(out[1].loss_mask) == out[1].n_tokens


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    result = chat_format(spark, sf_dir)
    assert got(result) == expected(rows)
    assert result.count() == len(expected(rows))
