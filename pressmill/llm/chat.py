"""Conversations as token sequences with a loss mask.

Every turn is ``<|turn|>`` role ``<|says|>`` text ``<|done|>``. The three marks are reserved ids
beyond the vocabulary; role and text are encoded on their own, so no token spans a mark and no
text can spell one: control strings in a text are escaped first (a backslash goes behind their
first sign), and the tokenizer takes its own special strings for ordinary text. The vocabulary
covers all bytes, so ids decode to exactly the text.

The mask comes from prefix sums. Lengths of segments, summed up, are the places where segments begin;
a one where a learned text begins and a minus one where it ends, summed up over the tokens, are the
mask. A turn is one row, and its place in the conversation is a running sum over the turns, so a
conversation of any length is never held in one place; reader and mask go by places in the conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

# Marks of this template, and control strings of common ones.
MARKS = ("<|turn|>", "<|says|>", "<|done|>")
CONTROLS = MARKS + ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|startoftext|>",
                    "<|im_start|>", "<|im_end|>")
VOCABULARY = "byte_bpe_50k.json"

_TURN = ("conv_id long, turn long, role string, n_tokens long, token_ids array<int>, loss_mask array<boolean>")
# None is the start or the end of another, so escaping one leaves no new one behind.
_PLAIN = re.compile("|".join(re.escape(c[0]) + r"(\\*)" + re.escape(c[1:]) for c in CONTROLS))


def escape(text: str) -> str:
    """No control string is left in the result; ``unescape`` gives the text back."""
    return _PLAIN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _PLAIN.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


@lru_cache(maxsize=2)
def tokenizer(vocabulary: str):
    """Loaded once a process."""
    import public_tokenizers
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    loaded.encode_special_tokens = True
    return loaded


def _encoded(vocabulary: str, learned: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(vocabulary)
        turn, says, done = range(coder.get_vocab_size(), coder.get_vocab_size() + 3)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                roles = [r or "" for r in part.column(2).to_pylist()]
                texts = [t or "" for t in part.column(3).to_pylist()]
                coded = [c.ids for c in coder.encode_batch([escape(x) for x in (*roles, *texts)], add_special_tokens=False)]
                n = len(roles)
                ids = [[turn, *coded[k], says, *coded[n + k], done] for k in range(n)]
                # Segments of all turns one after the other: mark, role, mark, text, mark.
                sizes = np.array([(1, len(coded[k]), 1, len(coded[n + k]), 1) for k in range(n)], np.int64).reshape(-1)
                begins = np.r_[0, np.cumsum(sizes)]
                taught = np.zeros(len(sizes), bool)
                taught[3::5] = [role in learned for role in roles]
                change = np.zeros(begins[-1] + 1, np.int8)
                np.add.at(change, begins[:-1][taught], 1)
                np.add.at(change, begins[1:][taught], -1)
                mask = np.cumsum(change, dtype=np.int8)[:-1].astype(bool)
                turns = begins[::5].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(roles, pa.string()), pa.array(np.diff(turns).astype(np.int64)),
                     pa.array(ids, pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array(turns), pa.array(mask))],
                    ["conv_id", "turn", "role", "n_tokens", "token_ids", "loss_mask"])

    return run


def format_chats(turns: DataFrame, vocabulary: str = VOCABULARY, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per turn: ``conv_id, turn, role, n_tokens, token_ids, loss_mask, position, first_token``.

    ``position`` counts the turns of a conversation from 0, ``first_token`` the tokens before
    the turn. ``loss_mask`` says of each token whether it counts for the loss: the text of
    ``learned`` roles does, without marks. Null role and text are empty. Null
    conversations are one conversation, null turns come first; equal turn numbers are ordered
    by role, then by their tokens, and repeated rows stay. Other columns are not read.
    """
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    coded = rows.mapInArrow(_encoded(vocabulary, learned), _TURN)
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "n_tokens", "token_ids")
    return coded.select(
        "*",
        (F.row_number().over(before) - 1).cast("long").alias("position"),
        F.coalesce(F.sum("n_tokens").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first_token"),
    )


def _read_back(vocabulary: str):
    """Turns in order -> one row per conversation, with digests kept up while turns pass by."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(vocabulary)
        base = coder.get_vocab_size()
        now, count, turns, chars, loss, shown, seen = None, 0, None, 0, None, 0, 0
        done = lambda: (now, count, turns.hexdigest(), chars, loss.hexdigest(), shown)
        for batch in batches:
            out = []
            columns = [batch.column(n) for n in ("conv_id", "first_token", "token_ids", "loss_mask")]
            for conv, first, ids, mask in zip(*columns):
                conv, first, ids = conv.as_py(), first.as_py(), ids.values.to_pylist()
                if first == 0:
                    if turns is not None:
                        out.append(done())
                    now, count, turns, chars, loss, shown, seen = conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0
                if first != seen:
                    raise ValueError(f"conversation {conv} goes on at token {first} after {seen} tokens")
                seen += len(ids)
                says = ids.index(base + 1)
                under = [i for i, m in zip(ids, mask.values.to_pylist()) if m]
                role, text, learned = coder.decode_batch(
                    [ids[1:says], ids[says + 1 : -1], under], skip_special_tokens=False)
                count += 1
                shown += sum(map(len, MARKS)) + len(role) + len(text)
                turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                learned = unescape(learned)
                chars += len(learned)
                loss.update(learned.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
        if turns is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in done()], names)

    return run


def read_chats(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """What the ids of ``format_chats`` say, per conversation: counts and digests."""
    ordered = formatted.select("conv_id", "first_token", "token_ids", "loss_mask")
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "first_token")
    return ordered.mapInArrow(
        _read_back(vocabulary),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chat_format(spark, sf_dir: str) -> DataFrame:
    """Contract of op3: all conversations and conversation -1, read back from their ids."""
    said = "</s>[INST] ok [/INST]"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    return read_chats(format_chats(rows.unionByName(extra)))
