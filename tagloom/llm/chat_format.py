"""Render conversations, encode them once with offsets, and mask what a model should learn."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
CONTROL = (
    TURN, END, "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|endoftext|>", "<|startoftext|>", "<|im_start|>", "<|im_end|>", "<unk>",
)
_CODES = {"\\": "\\\\"} | {text: f"\\{chr(97 + i)}" for i, text in enumerate(CONTROL)}
_PLAIN = {code: text for text, code in _CODES.items()}
_ESCAPE = re.compile("|".join(map(re.escape, sorted(_CODES, key=len, reverse=True))))
_UNESCAPE = re.compile(r"\\.", re.S)
SEGMENT_CHARS = 1 << 20

SEGMENTS = """conv_id long, segment long, formatted string, ids array<int>, starts array<int>, ends array<int>,
    loss array<boolean>, turn_starts array<int>, turn_ends array<int>, turn_loss array<boolean>"""


def escaped(text: str) -> str:
    """The text without any control string; ``unescaped`` gives it back."""
    return _ESCAPE.sub(lambda m: _CODES[m[0]], text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(lambda m: _PLAIN[m[0]], text)


def rendered(turns: list[tuple[str, str]], learn: str) -> tuple[str, list[int], list[int], list[bool]]:
    """The conversation as text, and where each turn's text starts and ends in it."""
    parts, at, starts, ends = [], 0, [], []
    for role, text in turns:
        head, body = f"{TURN}{escaped(role).replace(chr(10), chr(92) + 'z')}\n", escaped(text)
        starts.append(at + len(head))
        ends.append(at + len(head) + len(body))
        parts += [head, body, f"{END}\n"]
        at = ends[-1] + len(END) + 1
    return "".join(parts), starts, ends, [role == learn for role, _ in turns]


def parsed(formatted: str) -> Iterator[tuple[str, str]]:
    """Roles and texts back from a rendered conversation."""
    at = 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(END, line + 1)
        role = formatted[at + len(TURN) : line].replace("\\\\", "\0").replace("\\z", "\n").replace("\0", "\\\\")
        yield unescaped(role), unescaped(formatted[line + 1 : end])
        at = end + len(END) + 1


def covered(starts: np.ndarray, ends: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int]]:
    """What tokens cover of the span ``low:high``, each character once; tokens are found by binary search."""
    first, last = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")
    at = low
    for s, e in zip(starts[first:last].tolist(), ends[first:last].tolist(), strict=True):
        s, e = max(s, at), min(e, high)
        if s < e:
            yield s, e
            at = e


def format_chats(conversations: DataFrame, tokenizer_path: str, learn: str = "assistant") -> DataFrame:
    """Render and encode whole conversations; one row for each (``SEGMENTS``).

    ``conversations`` has ``conv_id, turn, role, text``; other columns are
    ignored.  Each turn becomes ``<|turn|>role\\ntext<|end|>\\n``.  Control
    strings and backslashes inside roles and texts are escaped reversibly.
    The text is encoded once with character offsets; a token is under the loss
    mask (``loss``) if it meets the text of a turn of the role ``learn``.  At
    the edge of a turn a token may hold characters of the template too:
    ``turn_starts`` and ``turn_ends`` say where the text ends.

    Conversations are sorted within partitions and streamed.  One of over
    ``SEGMENT_CHARS`` characters is cut between turns into numbered segments,
    which have the same tokens as the whole, since the encoder never joins a
    line feed to a following ``<``; so memory is bounded by the longest turn.
    Turns with the same number are ordered by role and text.  Null roles and
    texts are empty; a null ``conv_id`` is one conversation of its own.
    """

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tokenizers import Tokenizer, processors

        tokenizer = Tokenizer.from_file(tokenizer_path)
        tokenizer.encode_special_tokens = True
        tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)

        def segment(key, number: int, turns: list[tuple[str, str]]) -> tuple:
            text, starts, ends, loss = rendered(turns, learn)
            code = tokenizer.encode(text, add_special_tokens=False)
            spans = np.array(code.offsets, np.int64).reshape(-1, 2)
            mask = np.zeros(len(spans), bool)
            for s, e, learned in zip(starts, ends, loss, strict=True):
                if learned and s < e:
                    mask[np.searchsorted(spans[:, 1], s, "right") : np.searchsorted(spans[:, 0], e, "left")] = True
            return (key, number, text, code.ids, spans[:, 0].tolist(), spans[:, 1].tolist(), mask.tolist(), starts, ends, loss)

        names = [c.split()[0] for c in SEGMENTS.split(",")]
        key, number, turns, held, begun = None, 0, [], 0, False
        for frame in frames:
            out = []
            for conv, role, text in zip(frame["conv_id"], frame["role"], frame["text"], strict=True):
                conv = None if pd.isna(conv) else int(conv)
                role, text = role or "", text or ""
                if begun and (conv != key or held + len(text) > SEGMENT_CHARS):
                    out.append(segment(key, number, turns))
                    number = number + 1 if conv == key else 0
                    turns, held = [], 0
                key, begun = conv, True
                turns.append((role, text))
                held += len(text)
                if len(out) >= 256:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)
        if begun:
            yield pd.DataFrame([segment(key, number, turns)], columns=names)

    return (
        conversations.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInPandas(encode, SEGMENTS)
    )


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of what the rendered text and the mask hold, one row for each conversation.

    Returns ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``.  Roles and texts are parsed from the rendered text; the
    learned text is gathered from the spans of masked tokens.  Segments stream
    in order, so memory does not grow with a conversation.
    """

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: list | None = None

        def row() -> tuple:
            return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                conv = None if pd.isna(r.conv_id) else int(r.conv_id)
                if state is None or state[0] != conv:
                    if state:
                        out.append(row())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parsed(r.formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                masked = np.asarray(r.loss, bool)
                starts, ends = np.asarray(r.starts)[masked], np.asarray(r.ends)[masked]
                for low, high, learned in zip(r.turn_starts, r.turn_ends, r.turn_loss, strict=True):
                    if learned:
                        text = unescaped("".join(r.formatted[s:e] for s, e in covered(starts, ends, low, high)))
                        state[3] += len(text)
                        state[4].update(text.encode())
                state[5] += len(r.formatted)
            yield pd.DataFrame(out, columns=names)
        if state:
            yield pd.DataFrame([row()], columns=names)

    return (
        segments.select("conv_id", "segment", "formatted", "starts", "ends", "loss", "turn_starts", "turn_ends", "turn_loss")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "segment")
        .mapInPandas(
            digest,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
        )
    )
