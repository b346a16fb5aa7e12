"""Token counts with a whole-token shortcut.

For a sentencepiece BPE model the text falls into pre-tokens across which no merge can go. Which
vocabulary strings come out as one token when they stand alone is proved once, by encoding each
of them. Pre-tokens among those count one; only the rest are merged, once per distinct pre-token
and task. NULL and empty texts have no tokens. Rows that repeat are counted one by one; an empty
table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import id_and_text

SPACE = "▁"
# Distinct pre-tokens whose counts a worker remembers; the memory starts anew when it is full.
REMEMBERED = 200_000
# A blank run with the word behind it, blanks before a newline or the end, or one newline.
_PRE_TOKEN = re.compile(r" *[^ \n]+| +|\n")


@lru_cache(maxsize=2)
def _plain_encoder(model: str):
    """The model's encoder without the blank that it puts before a text; workers load the file themselves."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model, "rb") as file:
        proto.ParseFromString(file.read())
    spec = proto.normalizer_spec
    if not spec.add_dummy_prefix or spec.remove_extra_whitespaces or spec.precompiled_charsmap or not spec.escape_whitespaces:
        raise ValueError("the shortcut is proved for models that change blanks only")
    spec.add_dummy_prefix = False
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def prove_whole_tokens(model: str) -> frozenset[str]:
    """Vocabulary strings (with blanks for the blank sign) that alone encode as one token.

    Also proves the pre-token borders: no mergeable piece holds a blank sign behind another
    character, or a newline, so no merge crosses the borders and counts of pre-tokens add up.
    """
    encoder = _plain_encoder(model)
    whole = set()
    for i in range(encoder.get_piece_size()):
        piece = encoder.id_to_piece(i)
        if encoder.is_control(i) or encoder.is_unknown(i) or encoder.is_byte(i):
            continue
        if SPACE in piece.lstrip(SPACE) or "\n" in piece:
            raise ValueError(f"a merge may cross a pre-token border: {piece!r}")
        text = piece.replace(SPACE, " ")
        if len(encoder.encode(text)) == 1:
            whole.add(text)
    return frozenset(whole)


def token_counts(df: DataFrame, model: str, key: str = "doc_id", text: str = "text", limit: int = 4096) -> DataFrame:
    """One row per row of ``df``: doc_id, n_bytes, n_tokens, n_merged (pre-tokens that needed merging), over_limit.

    The set of whole tokens has at most as many entries as the vocabulary.
    """
    whole = df.sparkSession.sparkContext.broadcast(prove_whole_tokens(model))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, known, merged = _plain_encoder(model), whole.value, {}
        for frame in frames:
            tokens, rest = [], []
            for text in frame["text"]:
                total = n_rest = 0
                # a blank is put before the text, and the sign itself reads as a blank
                parts = Counter(_PRE_TOKEN.findall(" " + text.replace(SPACE, " "))) if text else {}
                for part, n in parts.items():
                    if part in known:
                        total += n
                        continue
                    size = merged.get(part)
                    if size is None:
                        if len(merged) >= REMEMBERED:
                            merged.clear()
                        size = merged[part] = len(encoder.encode(part))
                    total += n * size
                    n_rest += n
                tokens.append(total)
                rest.append(n_rest)
            yield frame[["doc_id", "n_bytes"]].assign(n_tokens=tokens, n_merged=rest)

    pair = id_and_text(df, key, text).withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = pair.schema["doc_id"].dataType.simpleString()
    counted = pair.mapInPandas(count, f"doc_id {kind}, n_bytes long, n_tokens long, n_merged long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
