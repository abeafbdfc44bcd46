"""SentencePiece BPE: encoding whole texts by a merge-type model, and decoding.

A text is encoded from a table of its prefixes. An automaton over all pieces
reports which pieces end at each character; the last token of a prefix is the one
match that the last token of the prefix before it is compatible with, that is,
whose joined characters merge back into just these two tokens. Merging applies
the best pair first and the leftmost of equals, and what it does in two neighbours
doesn't depend on the tokens around them unless something crosses their edge, so
a sequence is the encoding of its text exactly if all its neighbours are
compatible, and every prefix has one last token. The ids are then read from the
end of the table backwards. A text of n characters takes time in proportion to n,
also without any white space.

Texts are cut into units where no piece of the model reaches across (before a
space mark that follows another character, and at line ends), and a bounded memory
keeps the ids of units.

Defined cases: a null text counts as empty; an empty text has the end id alone.
Characters that the model doesn't know become the ids of their bytes. Text that
looks like a special token is ordinary text. Rows are encoded one by one, so
repeated rows, null ids and ties need no rule; an empty table gives an empty
result. Columns other than id and text are not looked at. Memory grows with the
longest text, not with the number of rows.
"""

from __future__ import annotations

import codecs
import hashlib
from itertools import chain

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import ship, small_batches, worker_memory

# Fixed values of the model format: the mark that stands for a space, and what an
# unknown id is decoded to.
MARK = "▁"
UNKNOWN_TEXT = " ⁇ "
#: Characters of a unit that is remembered at most.
LONGEST = 200

codecs.register_error(
    "each_byte", lambda error: ("�" * (error.end - error.start), error.end)
)


class Remembered(dict):
    """Keeps what ``make`` returned for a key; the older half goes when it is full."""

    def __init__(self, make, entries: int):
        super().__init__()
        self.make, self.entries, self.old = make, entries // 2, {}

    def __missing__(self, key):
        value = self.old[key] if key in self.old else self.make(key)
        if isinstance(key, str) and len(key) > LONGEST:
            return value
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceCodec:
    def __init__(self, path: str, entries: int = 300_000):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize(" ﬁ  ") != f"{MARK}{MARK}ﬁ{MARK}{MARK}":
            raise ValueError("only models that mark spaces and change nothing else are known")
        self.size, self.end = model.vocab_size(), model.eos_id()
        names = [model.id_to_piece(i) for i in range(self.size)]
        plain = [
            i for i in range(self.size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        self.control = {i for i in range(self.size) if model.is_control(i)}
        self.score = {names[i]: model.get_score(i) for i in plain}
        id_of = {names[i]: i for i in plain}
        self.byte_id = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(not model.is_byte(i) for i in self.byte_id):
            raise ValueError("the model has no bytes to fall back to")
        # A character that occurs inside pieces but is none itself can still be
        # merged; it takes part as a token of its own number beyond the vocabulary.
        self.alphabet = set("".join(id_of))
        loose = sorted(self.alphabet - id_of.keys())
        self.text = names + loose
        self.automaton = ahocorasick.Automaton()
        for number, piece in chain(
            ((i, p) for p, i in id_of.items()), enumerate(loose, self.size)
        ):
            self.automaton.add_word(piece, number)
        self.automaton.make_automaton()
        self.length = list(map(len, self.text))
        self.marks_lead = all(MARK not in p.lstrip(MARK) for p in id_of)
        self.line_apart = "\n" not in self.alphabet
        self.bytes_of = [b""] * self.size
        for i in plain:
            self.bytes_of[i] = names[i].replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_id):
            self.bytes_of[i] = bytes([b])
        self.bytes_of[model.unk_id()] = UNKNOWN_TEXT.encode()
        self.opens = [names[i].startswith(MARK) for i in range(self.size)]
        self.stands = [self._stands(piece) for piece in self.text]
        self.units = Remembered(self._encode_unit, entries)
        self.runs = Remembered(self.encode_run, entries)
        self.pairs = Remembered(self._compatible, 2 * entries)

    def _compatible(self, pair: int) -> bool:
        """Whether two tokens, joined and merged from their characters, stay two."""
        left, right = divmod(pair, len(self.text))
        edge = self.length[left]
        joined = self.text[left] + self.text[right]
        parts, starts = list(joined), list(range(len(joined)))
        gain = [self.score.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best, at = None, -1
            for i, score in enumerate(gain):
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return len(parts) == 2 and starts[1] == edge
            if starts[at + 1] == edge:
                return False
            parts[at] += parts.pop(at + 1)
            starts.pop(at + 1)
            gain.pop(at)
            if at:
                gain[at - 1] = self.score.get(parts[at - 1] + parts[at])
            if at < len(gain):
                gain[at] = self.score.get(parts[at] + parts[at + 1])

    def _stands(self, piece: str) -> bool:
        """Whether a token's characters merge back into it."""
        parts = list(piece)
        while len(parts) > 1:
            gains = [self.score.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            known = [g for g in gains if g is not None]
            if not known:
                return False
            at = gains.index(max(known))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    def encode_run(self, run: str) -> tuple[int, ...]:
        """Ids of characters as they are, by the table of prefixes."""
        n, width = len(run), len(self.text)
        last: list[int | None] = [None] * (n + 1)
        length, pairs, stands = self.length, self.pairs, self.stands
        for stop, token in self.automaton.iter(run):
            stop += 1
            if last[stop] is None:
                before = last[stop - length[token]]
                # The start of the run, and what no piece holds, are edges no merge
                # crosses; there is no token before the start.
                if stands[token] if before is None else pairs[before * width + token]:
                    last[stop] = token
        ids: list[int] = []
        while n:
            token = last[n]
            if token is None or token >= self.size:
                ids += [self.byte_id[b] for b in reversed(run[n - 1].encode())]
                n -= 1
            else:
                ids.append(token)
                n -= length[token]
        ids.reverse()
        return tuple(ids)

    def _encode_unit(self, unit: str) -> tuple[int, ...]:
        """Ids of a mark and ``unit``; lines are apart."""
        if not self.line_apart or "\n" not in unit:
            return self.encode_run(MARK + unit)
        first, *rest = unit.split("\n")
        ids = list(self.units[first])
        for line in rest:
            ids.append(self.byte_id[10])
            ids += self.runs[line]
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        """Ids without an end id, as for a text on its own."""
        if not text:
            return []
        marked = text.replace(" ", MARK)
        if not self.marks_lead:
            return list(self.encode_run(MARK + marked))
        parts = marked.split(MARK)
        if "" in parts:
            # Marks in a row belong to one unit with the word after them.
            joined, row = [], 0
            for part in parts:
                if part:
                    joined.append(MARK * row + part)
                    row = 0
                else:
                    row += 1
            if row:
                joined.append(MARK * (row - 1))
            parts = joined
        return list(chain.from_iterable(map(self.units.__getitem__, parts)))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the mark before it is dropped, bad bytes are replaced."""
        text, begin = "", 0
        # A control id stands for nothing, but bytes aren't joined across it.
        for stop in [*(i for i, c in enumerate(ids) if c in self.control), len(ids)]:
            raw = b"".join(map(self.bytes_of.__getitem__, ids[begin:stop]))
            text += raw.decode(errors="each_byte")
            begin = stop + 1
        first = next((i for i in ids if i not in self.control), None)
        return text[1:] if first is not None and self.opens[first] else text


def codec(path: str) -> PieceCodec:
    """The codec of this Python worker."""
    return worker_memory(("pieces", path), lambda: PieceCodec(path))


def _mapped(docs: DataFrame, id_col: str, value: str, as_type: str, names: str, kinds, convert):
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in small_batches(batches, 256):
            rows = [convert(v.as_py()) for v in batch.column("value")]
            columns = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns],
                names=["doc_id", *(name for name, _ in kinds)],
            )

    chosen = docs.select(
        F.col(id_col).alias("doc_id"), F.col(value).cast(as_type).alias("value")
    )
    return chosen.mapInArrow(run, f"doc_id {id_type}, {names}")


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int, the end id last) of every whole text."""

    def coded(text):
        coder = codec(path)
        return ([*coder.encode(text or ""), coder.end],)

    return _mapped(
        docs, id_col, text_col, "string", "ids array<int>", [("ids", pa.list_(pa.int32()))], coded
    )


def decode_documents(
    coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """``doc_id`` and the ``text`` that every row's ids stand for; null is empty."""
    return _mapped(
        coded, id_col, ids_col, "array<int>", "text string", [("text", pa.string())],
        lambda ids: (codec(path).decode(ids or []),),
    )


def round_trip_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_tokens``, and SHA-256 of the decimal ids and of the text
    decoded from them, without moving the ids between Python and Spark."""

    def digests(text):
        coder = codec(path)
        ids = [*coder.encode(text or ""), coder.end]
        return (
            len(ids),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(coder.decode(ids).encode()).hexdigest(),
        )

    return _mapped(
        docs, id_col, text_col, "string",
        "n_tokens long, ids_sha256 string, decoded_sha256 string",
        [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())],
        digests,
    )
