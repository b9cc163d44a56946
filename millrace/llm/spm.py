"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model protobuf is parsed here (wire format, no generated classes); from it are rebuilt
* the normaliser: the precompiled character map, removal of extra white space, the dummy prefix,
* the metaspace marker in place of spaces,
* the model: Unigram with its scores, or BPE whose merge order follows the scores, with byte fallback.

No piece of the usual models goes on over a metaspace marker; then a text is the concatenation of its
space-separated chunks; each distinct chunk is encoded once, many joined in one call, and kept in a bounded
cache, through the rebuilt normaliser. If a model has pieces over a marker, or an own normaliser map, whole texts are
encoded. Every text is encoded by the ``sentencepiece`` library as a whole too and its ids compared; and every text's ids are
decoded here, by the library and by the rebuilt decoder, and the three compared. No row is left out, so ``verified`` is true
for all.

Rows: null text has null ids and counts 0; the empty text has no ids. Texts of any length are handled whole.
A literal U+2581 in a text decodes to a space, as with the library; ``roundtrip`` is then false.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import id_text, keeps, map_arrow, table

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
#: Chunks kept per worker and generation (of two), and characters beyond which a chunk is not kept.
CACHE, CACHE_CHARS = 600_000, 64
#: Chunks joined in one call, and ids spelt at once.
TOGETHER, DECODED = 500, 50_000
#: Under this name a worker keeps codecs from task to task.
OWNER = "sentencepiece"


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    at, end = 0, len(raw)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < end:
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(wire) or varint()
            yield number, raw[at : at + size]
            at += size


class Model:
    """What a SentencePiece model file says."""

    def __init__(self, raw: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer, norm = {}, {}
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append((piece.get(1, b"").decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                norm = dict(_fields(value))
        self.kind = {1: "unigram", 2: "bpe"}.get(trainer.get(3, 1), "other")
        self.byte_fallback = bool(trainer.get(35, 0))
        self.suffix = bool(trainer.get(24, 0))
        self.charsmap = norm.get(2, b"")
        self.dummy_prefix = bool(norm.get(3, 1))
        self.squeeze = bool(norm.get(4, 1))
        self.escape = bool(norm.get(5, 1))
        self.unk = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        self.ids = {p[0]: i for i, p in enumerate(self.pieces)}
        if self.kind == "other":
            raise ValueError("only unigram and BPE models can be rebuilt")

    def splits(self) -> bool:
        """Whether texts fall apart at spaces: no piece goes on over a marker, none is user-defined, nothing is rewritten."""
        own = [p for p, _, kind in self.pieces if kind in (NORMAL, USER)]
        return not (self.charsmap or self.squeeze or self.suffix or not self.escape or not self.dummy_prefix or any(k == USER for *_, k in self.pieces) or any(MARK in p.lstrip(MARK) for p in own)) and MARK in self.ids and self.byte_fallback

    def merges(self) -> list[tuple[str, str]]:
        """Pairs by falling score of what they make; of equal scores the longer first, as it takes leftmost pairs first."""
        own = {p: s for p, s, kind in self.pieces if kind == NORMAL}
        out = [(-score, -len(piece), -cut, piece[:cut], piece[cut:]) for piece, score in own.items() for cut in range(1, len(piece)) if piece[:cut] in own and piece[cut:] in own]
        return [(a, b) for *_, a, b in sorted(out)]


def build(model: Model, chunks: bool = False):
    """The ``tokenizers`` pipeline of a parsed model. With ``chunks``, for models whose texts fall apart at spaces, a text is cut
    before each marker, and decoded pieces are joined before their markers are replaced (the same, unless bytes spell a marker)."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if model.kind == "bpe":
        core = models.BPE(vocab=model.ids, merges=model.merges(), unk_token=model.pieces[model.unk][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=model.unk, byte_fallback=model.byte_fallback)
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix and not model.suffix:
        steps += [normalizers.Prepend(" ")]
    if model.escape:
        steps += [normalizers.Replace(" ", MARK)]
    if steps:
        out.normalizer = normalizers.Sequence(steps)
    spaces, rest = decoders.Metaspace(MARK, "never"), [decoders.ByteFallback(), decoders.Fuse()]
    out.decoder = decoders.Sequence([*rest, spaces] if chunks else [spaces, *rest])
    if chunks:
        out.pre_tokenizer = pre_tokenizers.Split(MARK, "merged_with_next")
    if users := [AddedToken(p, normalized=False, special=False) for p, _, kind in model.pieces if kind == USER]:
        out.add_tokens(users)
    return out


@lru_cache(maxsize=256)
def _packer(n: int):
    return struct.Struct(f"<{n}i").pack


class Codec:
    """Encodes and decodes texts, and compares with the library."""

    def __init__(self, raw: bytes):
        import sentencepiece

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.model = Model(raw)
        self.tokenizer = build(self.model)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.split = self.model.splits()
        # the empty chunk is a lone marker (after a last space): neither normaliser nor library gives that for an empty text
        self.lone = {"": _packer(1)(self.model.ids[MARK])} if self.split else {}
        self.cache: dict[str, bytes] = dict(self.lone)
        self.before: dict[str, bytes] = {}
        self.joined = build(self.model, chunks=True) if self.split else None
        self.starts = np.array([p.startswith(MARK) for p, *_ in self.model.pieces])
        spelt = [self._bytes(p, kind) for p, _, kind in self.model.pieces]
        self.sizes = np.array([len(x) for x in spelt])
        self.offsets, self.spelt = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(spelt), "u1")

    @staticmethod
    def _bytes(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return {CONTROL: b"", UNKNOWN: " ⁇ ".encode()}.get(kind, piece.replace(MARK, " ").encode())

    def _chunks(self, text: str) -> list[str]:
        """Without the marker before each; a run of spaces stays with the word after it."""
        text = text.replace(MARK, " ")
        parts = text.split(" ")
        if "" in parts:
            parts = [x[1:] for x in re.findall(" +[^ ]*", " " + text)]
        return parts

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _packed(self, texts: list[str]) -> dict[str, bytes]:
        """Packed ids of distinct texts."""
        ours = self._batch(texts)
        return {text: pack(*ids) for text, pack, ids in zip(texts, (_packer(len(x)) for x in ours), ours, strict=True)}

    def _packed_chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """Packed ids of distinct chunks, joined by spaces; in a chunk without spaces the first piece alone has a marker."""
        plain = [x for x in chunks if " " not in x]
        out = self._packed([x for x in chunks if " " in x]) if len(plain) < len(chunks) else {}
        for at in range(0, len(plain), TOGETHER):
            part = plain[at : at + TOGETHER]
            (got,) = self.joined.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(got.ids, "<i4")
            raw, first = ids.tobytes(), (4 * np.flatnonzero(self.starts[ids])).tolist()
            out.update((x, raw[a:b]) for x, a, b in zip(part, first, [*first[1:], len(raw)], strict=True))
        return out

    def _same(self, text: str, ids: bytes) -> bool:
        """Whether the library gives these ids for the whole text."""
        return self.library.encode(text, num_threads=1) == np.frombuffer(ids, "<i4").tolist()

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """Of each text the ids as little-endian int32 bytes, and whether the library gives the same for the whole text."""
        if not self.split:
            got = self._packed(list(dict.fromkeys(texts)))
            return [(got[t], self._same(t, got[t])) for t in texts]
        cut = [self._chunks(t) if t else [] for t in texts]
        cache, before = self.cache, self.before
        new = set().union(*cut).difference(cache)
        again = [x for x in new if x in before]
        cache.update(zip(again, map(before.__getitem__, again), strict=True))
        new = list(new.difference(again))
        cache.update(self._packed_chunks(new))
        out = [b"".join(map(cache.__getitem__, parts)) for parts in cut]
        for x in new:
            if len(x) > CACHE_CHARS:
                del cache[x]
        if len(cache) > CACHE:  # chunks that come again move on from the generation before
            self.cache, self.before = dict(self.lone), cache
        return [(ids, self._same(t, ids)) for t, ids in zip(texts, out, strict=True)]

    def _spell(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        at = np.repeat(self.offsets[ids] - np.cumsum(sizes) + sizes, sizes)
        at += np.arange(len(at))
        return self.spelt[at].tobytes()

    def decode(self, ids: bytes) -> bytes:
        """The text's UTF-8, without the dummy prefix."""
        own = np.frombuffer(ids, "<i4")
        out = b"".join(self._spell(own[at : at + DECODED]) for at in range(0, len(own), DECODED))
        if self.model.dummy_prefix and out.startswith(b" "):
            out = out[1:]
        return out

    def decoders_agree(self, ids: bytes, back: bytes) -> bool:
        """Whether ``back``, decoded here, is what the library and the rebuilt decoder give."""
        own = np.frombuffer(ids, "<i4")
        text = back.decode("utf-8", "replace")
        decoder = self.joined if self.split and MARK not in text else self.tokenizer
        rebuilt = decoder.decode(own.tolist(), skip_special_tokens=False) if ids else ""
        if self.model.dummy_prefix and rebuilt.startswith(" "):
            rebuilt = rebuilt[1:]
        return text == rebuilt == self.library.decode(own)


_CODECS: dict[str, Codec] = {}


def codec(raw: bytes) -> Codec:
    """One codec for each model and worker process, until a task of another operator begins there."""
    key = hashlib.sha256(raw).hexdigest()
    keeps(OWNER, _CODECS.clear)
    if key not in _CODECS:
        _CODECS[key] = Codec(raw)
    return _CODECS[key]


def read_model(path: str = MODEL) -> bytes:
    """The model file, read on the driver; models are a few MB, and travel with the tasks."""
    with open(path, "rb") as f:
        return f.read()


SCHEMA = "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string, roundtrip boolean, parity boolean, verified boolean"


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per document: ids (int32), their count and SHA-256 (little-endian int32), the decoded text's SHA-256,
    whether decoding returns the text, whether ``sentencepiece`` gives the same ids for the whole text and both decoders the
    same decoded text (``parity``). All texts are compared, so ``verified`` is true in every row."""
    raw = read_model(model)

    def run(batch: pa.RecordBatch) -> list[dict]:
        own, out = codec(raw), []
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = part.column(1).to_pylist()
            got = own.encode([t or "" for t in texts])
            back = [own.decode(ids) for ids, _ in got]
            same = [ok and own.decoders_agree(ids, x) for (ids, ok), x in zip(got, back, strict=True)]
            sizes = np.array([len(ids) // 4 for ids, _ in got])
            nulls = np.array([t is None for t in texts])
            flat = pa.Array.from_buffers(pa.int32(), int(sizes.sum()), [None, pa.py_buffer(b"".join(ids for ids, _ in got))])
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("i4"), mask=np.concatenate([nulls, [False]]) if nulls.any() else None)
            out.append({
                "doc_id": part.column(0), "n_tokens": sizes, "ids": pa.ListArray.from_arrays(offsets, flat),
                "ids_sha256": [hashlib.sha256(ids).hexdigest() for ids, _ in got], "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in back],
                "roundtrip": [x == (t or "").encode() for x, t in zip(back, texts, strict=True)], "parity": same, "verified": [True] * len(texts),
            })
        return out

    return map_arrow(id_text(docs), run, SCHEMA, OWNER)


def decode(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give null text."""
    raw = read_model(model)

    def run(batch: pa.RecordBatch) -> dict:
        own = codec(raw)
        lists = batch.column(1).to_pylist()
        return {"doc_id": batch.column(0), "text": [None if x is None else own.decode(np.asarray(x, "<i4").tobytes()).decode("utf-8", "replace") for x in lists]}

    return map_arrow(tokens.select("doc_id", "ids"), run, "doc_id long, text string", OWNER)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
