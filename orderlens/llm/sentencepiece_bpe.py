"""Exact encoding with a merge-type SentencePiece model, and decoding.

Encoding walks a stretch of text left to right, taking the longest piece an Aho-Corasick automaton
finds.  A piece may follow another only if merging the characters of the two again gives just these
two pieces; otherwise the next shorter piece is tried, and when none is left the last piece is taken
back and its start is marked in a bitfield of positions that lead nowhere.  The result equals that of
applying all merges by score.

Text is cut where no merge can cross: between two characters that stand side by side in no piece, and
so before a run of spaces (checked when the model is read) and around characters that are in no
piece.  A task keeps stretches and units it has met lately, at most ``2 * CACHE`` of each.

Defined results: a null text is empty; an empty text has only the begin and end ids; texts of any length are
encoded whole; rows repeated whole, and tied or null ids, give a row each; merges of equal score are done leftmost
first; an empty table gives no rows; only the named columns are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

SPACE = "▁"
#: Stretches, and the units they are cut into, that a worker keeps, and the longest one that is kept.
CACHE, CACHE_CHARS = 200_000, 32
NEVER = 1 << 60
#: Texts whose results are handed on at a time.
ROWS = 1024
#: Piece types of the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Kept(dict):
    """Results by text, made when first asked for.  Short ones are kept in two generations of at most
    ``CACHE`` each: a full one becomes the old one, from which what is asked for again comes back."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, text: str) -> bytes:
        got = self.old.get(text)
        if got is None:
            got = self.make(text)
        if len(text) <= CACHE_CHARS:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[text] = got
        return got


class Model:
    """Pieces, scores and tables of a merge-type model (bytes of its file)."""

    def __init__(self, data: bytes):
        import ahocorasick
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        n = sp.get_piece_size()
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        if sp.normalize(" ① ") != SPACE * 2 + "①" + SPACE:
            raise ValueError("only models with identity normalisation and a leading space are supported")
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        kind = [CONTROL if sp.is_control(i) else UNKNOWN if sp.is_unknown(i) else BYTE if sp.is_byte(i)
                else UNUSED if sp.is_unused(i) else NORMAL for i in range(n)]
        normal = [i for i in range(n) if kind[i] == NORMAL]
        if any(SPACE in self.piece[i].lstrip(SPACE) for i in normal):
            raise ValueError("a piece has a space after another character")
        self.id = {self.piece[i]: i for i in normal}
        # merges by score; equal scores (there are none in practice) merge leftmost first
        scores = sorted({-sp.get_score(i) for i in normal})
        order = {x: r for r, x in enumerate(scores)}
        self.rank = {self.piece[i]: order[-sp.get_score(i)] for i in normal if len(self.piece[i]) > 1}
        self.byte = {int(self.piece[i][3:5], 16): i for i in range(n) if kind[i] == BYTE}
        if len(self.byte) != 256:
            raise ValueError("the model has no byte pieces")
        self.chars = frozenset(p for p in self.id if len(p) == 1)
        # characters side by side in some piece: between any other two, no merge can cross
        self.beside = frozenset(p[k:k + 2] for p in self.id for k in range(len(p) - 1))
        # a piece that its own merges do not give can never be in a result
        self.id = {p: i for p, i in self.id.items() if len(p) == 1 or self.merged(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.automaton.add_word(p, (len(p), p))
        self.automaton.make_automaton()
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.id), None) for p in self.id}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.units = Kept(lambda s: b"".join(i.to_bytes(4, "little") for i in self.unit(s)))
        self.stretches = Kept(lambda s: self.stretch(s.replace(" ", SPACE)))
        # what decoding gives for each id: text, or a byte
        self.value = [int(self.piece[i][3:5], 16) if kind[i] == BYTE else "" if kind[i] == CONTROL
                      else " ⁇ " if kind[i] == UNKNOWN else self.piece[i].replace(SPACE, " ") for i in range(n)]
        self.raw = [bytes([v]) if isinstance(v, int) else v.encode() for v in self.value]

    def forget(self) -> None:
        """Drop what was kept while a task ran."""
        for kept in (self.stretches, self.units):
            kept.clear()
            kept.old = {}
        self.pairs.clear()

    def merged(self, text: str) -> list[str]:
        """Pieces of ``text`` by applying the best merge again and again (ties: leftmost)."""
        parts, rank, never = list(text), self.rank.get, NEVER
        ranks = [rank(x + y, never) for x, y in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != never:
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], never)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], never)
        return parts

    def compatible(self, a: str, b: str) -> bool:
        if (known := self.pairs.get((a, b))) is None:
            if len(self.pairs) >= 4 * CACHE:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return known

    def backtracked(self, text: str) -> list[str]:
        """Pieces of ``text``, all of whose characters are in the model."""
        n = len(text)
        longest: list = [None] * n
        for end, (size, p) in self.automaton.iter(text):
            longest[end - size + 1] = p  # later ends are longer
        open_ = bytearray(b"\x01") * (n + 1)  # positions not yet known to lead nowhere
        pieces: list[str] = []
        at, piece = 0, longest[0]
        while True:
            last = pieces[-1] if pieces else None
            while piece is not None and not (open_[at + len(piece)] and (last is None or self.compatible(last, piece))):
                piece = self.shorter[piece]
            if piece is not None:
                pieces.append(piece)
                at += len(piece)
                if at == n:
                    return pieces
                piece = longest[at]
            else:
                open_[at] = 0
                piece = pieces.pop()
                at -= len(piece)

    def unit(self, text: str) -> list[int]:
        """Ids of a text that no cut parts; a character that is in no piece gives its bytes."""
        if (known := self.id.get(text)) is not None:  # such a piece is what its own merges give
            return [known]
        if len(text) == 1:
            return [self.byte[b] for b in text.encode()]
        return [self.id[p] for p in self.backtracked(text)]

    def stretch(self, text: str) -> bytes:
        """Packed ids of a stretch, cut wherever no merge can cross."""
        beside = self.beside
        cuts = [i for i in range(1, len(text)) if text[i - 1:i + 1] not in beside]
        if not cuts:
            return self.units[text]
        return b"".join([self.units[text[i:j]] for i, j in zip([0, *cuts], [*cuts, len(text)])])

    def decoded(self, ids: list[int]) -> str:
        """The pieces' texts; bytes side by side become characters, each bad byte U+FFFD."""
        out: list[str] = []
        raw = bytearray()
        for i in [*ids, None]:
            v = "" if i is None else self.value[i]
            if isinstance(v, int):
                raw.append(v)
                continue
            if raw:
                out.append(_characters(bytes(raw)))
                raw.clear()
            out.append(v)
        return "".join(out)

    def decode(self, ids) -> str:
        """As the library's ``decode``: the leading space that encoding adds is taken off."""
        try:
            out = b"".join(map(self.raw.__getitem__, ids)).decode()
        except UnicodeDecodeError:  # bytes that are no characters
            out = self.decoded(list(ids))
        first = next((i for i in ids if i not in (self.bos, self.eos)), None)
        return out[1:] if first is not None and self.piece[first].startswith(SPACE) else out

    def encode_packed(self, text: str) -> bytes:
        """Ids between begin and end as little-endian 32-bit integers."""
        if SPACE in text:  # in this model's texts it is a space
            text = text.replace(SPACE, " ")
        return b"".join(map(self.stretches.__getitem__, STRETCH.findall(" " + text))) if text else b""

    def encode(self, text: str) -> list[int]:
        packed = self.encode_packed(text)
        return [self.bos, *memoryview(packed).cast("I"), self.eos] if packed else [self.bos, self.eos]


STRETCH = re.compile(r"\n| +[^ \n]*|[^ \n]+")
_MODELS: dict[str, Model] = {}


def _characters(raw: bytes) -> str:
    out, i = [], 0
    while i < len(raw):
        for k in range(1, 5):
            try:
                out.append(raw[i:i + k].decode())
                i += k
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            i += 1
    return "".join(out)


def _model(data: bytes) -> Model:
    """The worker's model: its tables are built once a process."""
    key = hashlib.sha256(data).hexdigest()
    if key not in _MODELS:
        _MODELS[key] = Model(data)
    return _MODELS[key]


def encode_documents(docs: DataFrame, model_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                     tokens: bool = False) -> DataFrame:
    """``keep`` columns, ``n_tokens, ids_sha256, decoded_sha256`` and, with ``tokens``, ``ids array<int>``
    and ``decoded`` of every row.  No shuffle; the model file is bounded and travels with the tasks."""
    with open(model_path, "rb") as f:
        data = f.read()
    model = docs.sparkSession.sparkContext.broadcast(data)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    fields += ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    if tokens:
        fields += ["ids array<int>", "decoded string"]
    keep = list(keep)

    def encode(batches):
        m = _model(model.value)
        try:
            for b in batches:
                for i in range(0, b.num_rows, ROWS):
                    yield encoded(m, b.slice(i, ROWS))
        finally:
            m.forget()  # the worker may live on, with other work

    def encoded(m, b):
        import numpy as np
        import pyarrow as pa
        bos, eos = m.bos.to_bytes(4, "little"), m.eos.to_bytes(4, "little")
        counts, id_sums, text_sums, all_ids, texts = [], [], [], [], []
        for v in b.column(len(keep)):
            packed = bos + m.encode_packed(v.as_py() or "") + eos
            back = m.decode(memoryview(packed).cast("I"))
            counts.append(len(packed) // 4)
            id_sums.append(hashlib.sha256(packed).hexdigest())
            text_sums.append(hashlib.sha256(back.encode()).hexdigest())
            if tokens:
                all_ids.append(np.frombuffer(packed, "<u4").astype(np.int32))
                texts.append(back)
        cols = [*b.columns[:len(keep)], pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())]
        names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
        if tokens:
            cols += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(*keep, docs[text_col].cast("string").alias("_text")).mapInArrow(encode, ", ".join(fields))
