"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole from a template, encoded once with offsets,
and the sorted spans of its assistant texts are intersected with the token
spans by binary search. Template strings inside texts are escaped reversibly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import text_of, tokenizer, written

#: Strings that templates of chat models use for control.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
           "<<SYS>>", "<</SYS>>")
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
#: Characters after which a very long conversation goes on in another part.
PART_CHARS = 4_000_000

_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_ESCAPED = re.compile(r"\\([\\,n])")
_TURN = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE), re.S)


def escape(text: str) -> str:
    r"""``\`` becomes ``\\``; ``\,`` (which stands for nothing) breaks each control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\," + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: {"\\": "\\", ",": "", "n": "\n"}[m[1]], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the character spans of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = OPEN + escape(role).replace("\n", "\\n") + "\n"
        body = escape(text)
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, CLOSE)
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation (the inverse of :func:`render`)."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens overlap a span; both are sorted, so binary search finds each token's span."""
    spans = [span for span in spans if span[0] < span[1]]
    if not spans or not len(offsets):
        return np.zeros(len(offsets), bool)
    starts, ends = np.array(spans).T
    nearest = np.searchsorted(ends, offsets[:, 0], side="right")  # first span ending after it
    inside = nearest < len(ends)
    return inside & (offsets[:, 1] > starts[np.minimum(nearest, len(ends) - 1)])


def masked_text(formatted: str, offsets: np.ndarray, mask: np.ndarray,
                spans: list[tuple[int, int]]) -> list[str]:
    """The unescaped text of each span that masked tokens cover (all of it, if the mask is right)."""
    out = []
    kept = offsets[mask]
    for start, end in spans:
        a, b = np.searchsorted(kept[:, 1], start, "right"), np.searchsorted(kept[:, 0], end)
        if a < b:
            out.append(unescape(formatted[max(start, kept[a, 0]):min(end, kept[b - 1, 1])]))
    return out


def format_chats(conversations: DataFrame, tokenizer_path: str, part_chars: int = PART_CHARS
                 ) -> DataFrame:
    """``conv_id, part, formatted, token_ids, token_starts, token_ends, loss_mask, loss_spans``.

    One row per conversation; beyond ``part_chars`` characters it goes on, at a
    turn, in a further part, so a task's memory is bounded by one part and one
    turn. Turns are in the order of ``turn`` (nulls first), then role and text; a null text or
    role is empty; a null ``conv_id`` is a conversation of its own; repeated
    rows are repeated turns. Offsets are in code points, of ``formatted``. Extra
    columns are ignored; an empty table gives no rows.
    """
    rows = (conversations.select("conv_id", "turn", text_of("role").alias("role"),
                                 text_of("text").alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def encode(conv_id, part: int, turns: list[tuple[str, str]]) -> tuple:
        formatted, spans = render(turns)
        encoded = tokenizer(tokenizer_path).encode(formatted, add_special_tokens=False)
        offsets = np.array(encoded.offsets, dtype=np.int64).reshape(-1, 2)
        return (conv_id, part, formatted, encoded.ids, offsets[:, 0], offsets[:, 1],
                loss_mask(offsets, spans), [x for span in spans for x in span])

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, part, turns, chars, out, held = None, 0, [], 0, [], 0
        started = False
        for batch in batches:
            ids = batch["conv_id"].astype(object).where(batch["conv_id"].notna(), None)
            for conv_id, role, text in zip(ids, batch["role"], batch["text"], strict=True):
                changed = not started or conv_id != current
                if turns and (changed or chars > part_chars):
                    out.append(encode(current, part, turns))
                    turns, held, chars, part = [], held + chars, 0, part + 1
                if changed:
                    current, part, started = conv_id, 0, True
                turns.append((role, text))
                chars += len(text) + len(role)
                if held > part_chars:
                    yield frame(out)
                    out, held = [], 0
        if turns:
            out.append(encode(current, part, turns))
        yield frame(out)

    def frame(out: list[tuple]) -> pd.DataFrame:
        df = pd.DataFrame(out, columns=["conv_id", "part", "formatted", "token_ids",
                                        "token_starts", "token_ends", "loss_mask", "loss_spans"])
        return df.astype({"conv_id": "Int64"})

    return rows.mapInPandas(write, (
        "conv_id long, part int, formatted string, token_ids array<int>, token_starts array<int>,"
        " token_ends array<int>, loss_mask array<boolean>, loss_spans array<int>"))


def chat_facts(chats: DataFrame) -> DataFrame:
    """Digests of formatted conversations, read back from their rows.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``:
    the turns are parsed from the formatted text, and the loss text is what the
    masked tokens cover, unescaped.
    """
    rows = chats.repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, started, state = None, False, None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                conv_id = None if pd.isna(row.conv_id) else int(row.conv_id)
                if not started or conv_id != current:
                    if started:
                        out.append(result(current, state))
                    current, started = conv_id, True
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(row.formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                offsets = np.column_stack([row.token_starts, row.token_ends])
                spans = np.asarray(row.loss_spans, dtype=np.int64).reshape(-1, 2)
                for text in masked_text(row.formatted, offsets,
                                        np.asarray(row.loss_mask, dtype=bool), spans.tolist()):
                    state[2] += len(text)
                    state[3].update(text.encode("utf-8", "surrogatepass"))
                state[4] += len(row.formatted)
            yield frame(out)
        yield frame([result(current, state)] if started else [])

    def result(conv_id, state: list) -> tuple:
        return (conv_id, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

    def frame(out: list[tuple]) -> pd.DataFrame:
        df = pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars",
                                        "loss_sha256", "formatted_chars"])
        return df.astype({"conv_id": "Int64"})

    return rows.mapInPandas(fold, "conv_id long, n_turns long, turns_sha256 string, "
                                  "loss_chars long, loss_sha256 string, formatted_chars long")


def format_and_read_back(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the formatted conversations to the shared folder; facts read back from there."""
    return chat_facts(written(format_chats(conversations, tokenizer_path), "chats"))


def with_control_example(conversations: DataFrame) -> DataFrame:
    """``conversations`` plus conversation -1, whose two texts consist of control strings."""
    said = "</s>[INST] ok [/INST]"
    extra = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, LOSS_ROLE, said)],
        "conv_id long, turn long, role string, text string")
    return conversations.select(*(F.col(c).cast(t) for c, t in extra.dtypes)).unionAll(extra)
