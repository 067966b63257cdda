"""Encoding with a tokenizer file whose tokens never cross white space.

Texts are cut at spaces and line ends, which such a tokenizer drops, and each distinct
piece is encoded once per worker by the library, in batches. Ids travel as little-endian
unsigned 32-bit integers.
"""

from __future__ import annotations

import json
import re
import string
import sys
import unicodedata
from collections.abc import Callable
from struct import Struct

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from skewdex.llm.arrow import kept, map_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pieces a worker remembers, half of them from before it started anew, and the longest that it remembers.
REMEMBERED, REMEMBERED_CHARS = 550_000, 48
#: Fixed value: the rule by which such a tokenizer cuts normalised text.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The one letter whose lower case depends on its neighbours in Python, but not in the library.
SIGMA = "\u03a3"
#: Marks that end a word and are cut off by the rule, as one run; the apostrophe has rules of its own.
MARKS = string.punctuation.replace("'", "")
#: A comma or full stop before a space that may belong to a run of marks, as no letter or digit is before it.
RUNS = re.compile(r"[,.](?<![^\W_][,.]) ")


def _cuts_plainly(tokenizer_json: str) -> bool:
    """Whether the file composes and lower-cases text and cuts it by ``CUT``, all on single characters."""
    content = json.loads(tokenizer_json)
    before, cut = content.get("normalizer") or {}, content.get("pre_tokenizer") or {}
    steps = [step["type"] for step in before.get("normalizers", ())]
    parts = {part["type"]: part for part in cut.get("pretokenizers", ())}
    return (
        content["model"]["type"] == "BPE" and steps == ["NFC", "Replace", "Lowercase"] and list(parts) == ["Split", "ByteLevel"]
        and parts["Split"]["pattern"] == {"Regex": CUT} and parts["Split"]["invert"]
        and not parts["ByteLevel"]["add_prefix_space"] and not parts["ByteLevel"]["use_regex"]
    )


def _shown_bytes() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can be shown."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + at for at, b in enumerate(hidden)}


def piece_encoder(tokenizer_json: str) -> Callable[[str], bytes]:
    """A function from text to ids; equal to the library's result for the whole text.

    Where the file cuts plainly, a word of letters and the marks after it go straight to the
    library's model, each once; all other pieces are encoded as texts.
    """
    library = Tokenizer.from_str(tokenizer_json)
    library.no_truncation()
    model, plain, shown = library.model, _cuts_plainly(tokenizer_json), _shown_bytes()
    others: dict[str, None] = {}
    tokenize, several = model.tokenize, [Struct(f"<{n}I").pack for n in range(REMEMBERED_CHARS + 1)]

    def word(text: str) -> bytes:
        if (ids := known.get(text) or before.get(text)) is None:
            # Letters and marks in ASCII stand for themselves.
            found = tokenize(text if text.isascii() else text.encode().decode("latin-1").translate(shown))
            numbers = [token.id for token in found]
            ids = known[text] = several[len(numbers)](*numbers) if len(numbers) < len(several) else np.array(numbers, "<u4").tobytes()
        return ids

    def quickly(piece: str) -> bytes | None:
        letters = piece.rstrip(MARKS)
        if not letters.isalpha() or len(piece) > REMEMBERED_CHARS:
            return None
        if letters.isascii():
            lower = letters.lower()
        else:
            lower = unicodedata.normalize("NFC", letters)
            lower = "".join(map(str.lower, lower)) if SIGMA in lower else lower.lower()
            if not lower.isalpha():
                return None
        return word(lower) if letters == piece else word(lower) + word(piece[len(letters) :])

    class Known(dict):
        """Ids of pieces; a new one that has to be encoded as a text is put aside."""

        def __missing__(self, piece: str) -> bytes | None:
            ids = before.get(piece)
            if ids is None and plain:
                ids = quickly(piece)
            if ids is None:
                others[piece] = None
            else:
                self[piece] = ids
            return ids

    known, before = Known({"": b""}), {}

    def encode(text: str) -> bytes:
        nonlocal known, before
        if len(known) > REMEMBERED // 2:  # what comes up again is taken over
            known, before = Known({"": b""}), known
        text = text.replace("\n", " ")
        if plain and not RUNS.search(text):
            text = text.replace(", ", " , ").replace(". ", " . ")  # fewer different pieces
        pieces = text.split(" ")
        found = list(map(known.__getitem__, pieces))
        if others:
            encoded = library.encode_batch_fast(list(others), add_special_tokens=False)
            ids_of = {piece: np.array(e.ids, "<u4").tobytes() for piece, e in zip(others, encoded, strict=True)}
            others.clear()
            known.update((piece, ids) for piece, ids in ids_of.items() if len(piece) <= REMEMBERED_CHARS)
            found = [ids_of[piece] if ids is None else ids for piece, ids in zip(pieces, found)]
        return b"".join(found)

    return encode


def encode(df: DataFrame, id_col: str, text_col: str, tokenizer_json: str, end_id: int | None = None) -> DataFrame:
    """(``id_col``, tokens): the ids of each whole text and then ``end_id``, as bytes.

    One row per row of ``df``, in its order and partitions. A null text counts as empty.
    ``tokenizer_json`` is the content of the file: executors need no copy of it.
    """
    schema = T.StructType([df.schema[id_col], T.StructField("tokens", T.BinaryType())])
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def make():
        encoder = kept(("word_bpe", tokenizer_json), lambda: piece_encoder(tokenizer_json))

        def step(emit, doc, text):
            tokens = encoder(text or "") + end
            emit(doc, tokens, size=64 + len(tokens))

        return step

    return map_rows(df.select(F.col(id_col), F.col(text_col)), schema, make)
