"""Byte-level BPE by forced-boundary splitting.

A merge can only build a token of the vocabulary, so between two bytes that
stand side by side inside *no* token no merge ever reaches across: the cut
there is certain.  The vocabulary's table of inner pairs is made once; a text
is first cut where the table allows no blank or line break after a visible
byte (checked against the table, not assumed), and each word, after the
pre-tokenizer's own boundaries, at every other pair that is not in it.
Every fragment is merged on its own (each distinct word once per task, through
a bounded cache) and the ids are concatenated.  The result equals the library's
encoding of the whole text; tests hold both together.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from .common import tidy

# The byte-level pre-tokenizer's pattern, and Unicode white space.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)   # the same for ASCII texts
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CERTAIN = re.compile(f"(?<=[^{WHITE}]) ")
FRAGMENT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
# White space other than single blanks and single line breaks between visible characters.
ODD_PAIRS = ("  ", " \n", "\n ", "\n\n")
ODD_ASCII = "\t\x0b\x0c\r"
ODD_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

CACHE_ENTRIES = 150_000       # fragments a worker remembers in a generation (of two) of each kind
PART = 1 << 18                # characters of a text that are cut into fragments at once
CACHED_LENGTH = 64            # longer words are not remembered
TOGETHER = 1 << 23            # characters whose distinct words are looked up together
NO_SPECIAL: set[str] = set()


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in character -> byte, as byte-level vocabularies write
    them: printable Latin-1 stands for itself, the rest follows from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, n = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            table[chr(n)] = b
            n += 1
    return table


class Fragments(dict):
    """Fragment -> its ids as little-endian unsigned 32-bit words; ``lead`` stands before every key."""

    def __init__(self, encode, lead: str = ""):
        super().__init__()
        self.encode, self.lead = encode, lead
        self.before: dict[str, bytes] = {}     # the generation before: what is met again moves up

    def __missing__(self, fragment):
        ids = self.before.get(fragment)
        if ids is None:
            ids = self.encode(self.lead + fragment)
        if len(fragment) <= CACHED_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.before = dict(self)
                self.clear()
            self[fragment] = ids
        return ids


class Words:
    """What ``encode_all`` gives for words, asked for all new ones of a run of texts at once."""

    def __init__(self, encode_all):
        self.encode_all = encode_all
        self.known: dict = {}
        self.before: dict = {}     # the generation before: what is met again moves up

    def look_up(self, words: list[str]) -> list:
        """One value per word; the words are distinct."""
        out = list(map(self.known.get, words))
        missing = [i for i, x in enumerate(out) if x is None]
        old = list(map(self.before.get, [words[i] for i in missing])) if self.before else [None] * len(missing)
        new = [i for i, x in zip(missing, old) if x is None]
        made = iter(self.encode_all([words[i] for i in new]) if new else ())
        for i, x in zip(missing, old):
            out[i] = x = next(made) if x is None else x
            if len(words[i]) < CACHED_LENGTH:
                self.known[words[i]] = x
        if len(self.known) >= CACHE_ENTRIES:
            self.before, self.known = self.known, {}
        return out


def words_of(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words between blanks of some texts: the distinct ones, the number of each word
    in turn among them, and the bounds of each text's words (one more than texts)."""
    words = pc.split_pattern(pa.array(texts, pa.string()), " ")
    coded = words.values.dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), words.offsets.to_numpy()


def joined(parts: list[bytes], which: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Per text the parts of its words, one after the other."""
    if len(bounds) < 2:
        return []
    laid = pa.array(parts, pa.large_binary()).take(pa.array(which))
    ends = np.frombuffer(laid.buffers()[1], "<i8", len(laid) + 1, 8 * laid.offset)[bounds].tolist()
    data = memoryview(laid.buffers()[2] or b"")
    return [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]


class ByteBpe:
    """Encoder and decoder of one vocabulary file (a ``tokenizers`` JSON)."""

    def __init__(self, path: str, cut_words: bool = True):
        self.cut_words = cut_words
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        alphabet = byte_alphabet()
        model = spec["model"]
        self.id_of = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items()}
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {tuple(bytes(alphabet[c] for c in side) for side in pair): r for r, pair in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        size = max([*self.id_of.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in self.id_of.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.decimal = [str(i) for i in range(size)]
        self.inside = {pair for token in self.id_of for pair in zip(token, token[1:])}
        self.fragments = Fragments(self.encode_fragment)
        self.blank_led = Fragments(self.encode_fragment, " ")
        self.break_led = Fragments(self.encode_fragment, "\n")
        self.words = Words(self.encode_led)
        self.width = np.array([len(x) for x in self.bytes_of], np.int64)

    @cached_property
    def core(self):
        """tiktoken's merge loop for one fragment, where the file allows it: one merge a
        token, in the order of the ids.  (None: :meth:`merge` does them all.)"""
        made = [self.id_of[a + b] for a, b in self.rank]
        if made != sorted(set(made)) or len(made) + 256 != len(self.id_of) or any(bytes([x]) not in self.id_of for x in range(256)):
            return None
        import tiktoken

        return tiktoken.Encoding("fragments", pat_str=PIECES.pattern, mergeable_ranks=self.id_of, special_tokens={})._core_bpe

    @cached_property
    def cut_at_blanks(self) -> bool:
        """No token holds a blank or a line break after a byte that can't end white space: words part
        there.  (After a visible character whose last byte also ends some white space, as of a
        no-break blank, it is the pre-tokenizer that never joins the two.)"""
        ends = {chr(c).encode()[-1] for c in range(0x3001) if chr(c).isspace()}
        return not any(after in (10, 32) and before not in ends for before, after in self.inside)

    def forced_fragments(self, piece: bytes) -> Iterator[bytes]:
        """``piece`` cut between all byte pairs that no token holds."""
        inside, start = self.inside, 0
        for i, pair in enumerate(zip(piece, piece[1:]), 1):
            if pair not in inside:
                yield piece[start:i]
                start = i
        yield piece[start:]

    def merge(self, fragment: bytes) -> list[int]:
        """BPE of one fragment: the lowest-ranked pair first, leftmost of equals.

        Long fragments (no cut, so one word-like run) keep a heap of pairs, so
        the time stays near linear."""
        parts = [fragment[i:i + 1] for i in range(len(fragment))]
        if len(parts) > 200:
            return self._merge_long(parts)
        rank = self.rank
        while len(parts) > 1:
            ranks = [rank.get(p, 1 << 60) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.id_of[p] for p in parts]

    def _merge_long(self, parts: list[bytes]) -> list[int]:
        import heapq

        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1)
                if (r := self.rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, b""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and (right := after[left]) < n:
                    r = self.rank.get((parts[left], parts[right]))
                    if r is not None:
                        heapq.heappush(heap, (r, left, parts[left], parts[right]))
        return [self.id_of[p] for p in parts if p]

    def encode_fragment(self, text: str) -> bytes:
        """A word, or a run of text, through the pre-tokenizer, the table's cuts and the merges."""
        if not self.cut_words and self.core and len(text) <= CACHED_LENGTH:
            return bytes(self.core.encode_to_tiktoken_buffer(text, NO_SPECIAL))
        if (text[1:] if text[:1] == " " else text).isalpha():          # letters alone are one piece
            ids = self._merge_piece(text.encode())
        else:
            ids = []
            for piece in (ASCII_PIECES if text.isascii() else PIECES).findall(text):
                ids += self._merge_piece(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_led(self, words: list[str]) -> list[bytes]:
        """Each word with a blank before it.  Short ones, without a blank or other white space at
        their ends, are merged in one call and parted where their bytes end."""
        if self.cut_words or not self.core or not self.cut_at_blanks:
            return [self.encode_fragment(" " + w) for w in words]
        short = [w for w in words if len(w) < CACHED_LENGTH and w and w[-1] != "\n"]
        ids = bytes(self.core.encode_to_tiktoken_buffer("".join([" " + w for w in short]), NO_SPECIAL))
        ends = np.cumsum([len(w.encode()) + 1 for w in short])
        at = [0, *(4 * (np.searchsorted(np.cumsum(self.width[np.frombuffer(ids, "<u4")]), ends) + 1)).tolist()]
        parts = (ids[a:b] for a, b in zip(at, at[1:]))
        return [next(parts) if len(w) < CACHED_LENGTH and w and w[-1] != "\n" else self.encode_fragment(" " + w) for w in words]

    def _merge_piece(self, raw: bytes) -> list[int]:
        if self.inside.issuperset(zip(raw, raw[1:])):
            return self._merge_fragment(raw)
        return [i for fragment in self.forced_fragments(raw) for i in self._merge_fragment(fragment)]

    def _merge_fragment(self, fragment: bytes) -> list[int]:
        return self.core.encode_single_piece(fragment) if len(fragment) <= 200 and self.core else self.merge(fragment)

    @staticmethod
    def lone_white(text: str) -> bool:
        """White space is single blanks and single line breaks, none beside another."""
        return not (any(p in text for p in ODD_PAIRS) or any(c in text for c in ODD_ASCII) or not text.isascii() and ODD_WIDE.search(text))

    def _encode_plain(self, text: str) -> bytes:
        """A text without special tokens.  Where white space only ever stands alone, every blank
        and line break opens a fragment; other texts are cut by pattern before runs of white space."""
        if not self.cut_at_blanks:
            return self.encode_fragment(text)
        if not self.lone_white(text):
            return b"".join(map(self.fragments.__getitem__, FRAGMENT.findall(text)))
        out: list[bytes] = []
        opening = self.fragments
        for line in text.split("\n"):
            words = line.split(" ")
            if words[0] or opening is not self.fragments:
                out.append(opening[words[0]])
            out += map(self.blank_led.__getitem__, words[1:])
            opening = self.break_led
        return b"".join(out)

    def _encode_long(self, text: str) -> bytes:
        """A long text in parts of about ``PART`` characters, each cut where a blank follows a visible character."""
        out, at = [], 0
        while at < len(text):
            cut = CERTAIN.search(text, at + PART) if len(text) - at > PART and self.cut_at_blanks else None
            end = cut.start() if cut else len(text)
            out.append(self._encode_plain(text[at:end]))
            at = end
        return b"".join(out)

    def encode_plain(self, text: str) -> bytes:
        """Ids of a whole text in which special tokens' strings are plain text."""
        return self._encode_plain(text) if len(text) <= PART else self._encode_long(text)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, packed as little-endian unsigned 32-bit words."""
        if self.special_at is None or not any(s in text for s in self.special):
            return self.encode_plain(text)
        out = []
        for part in self.special_at.split(text):
            if part in self.special:
                out.append(np.asarray([self.special[part]], "<u4").tobytes())
            else:
                out.append(self._encode_long(part))
        return b"".join(out)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """:meth:`encode` of each text, each distinct word between blanks of all of them looked up once."""
        simple = [i for i, t in enumerate(texts) if self.cut_at_blanks and 0 < len(t) <= PART and self.lone_white(t) and not any(s in t for s in self.special)]
        words, which, bounds = words_of([texts[i] for i in simple])
        first, which = bounds[:-1], which.copy()
        opening = [words[w] for w in which[first].tolist()]               # no blank stands before a text's first word
        which[first] = np.arange(len(words), len(words) + len(opening))
        ids = dict(zip(simple, joined([*self.words.look_up(words), *map(self.fragments.__getitem__, opening)], which, bounds)))
        return [ids[i] if i in ids else self.encode(t) for i, t in enumerate(texts)]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")

    def digits(self, ids: bytes) -> str:
        """Decimal ids joined by commas."""
        return ",".join(map(self.decimal.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def byte_bpe(path: str, cut_words: bool = True) -> ByteBpe:
    """One encoder per worker process and vocabulary file."""
    return ByteBpe(path, cut_words)


def public_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _vocabulary(path: str | None) -> str:
    return path or public_vocabulary()


def together(column: pa.Array) -> Iterator[list[str]]:
    """A column's texts (null: empty) in runs of about ``TOGETHER`` characters."""
    texts, size = [], 0
    for t in column:
        texts.append(t.as_py() or "")
        size += len(texts[-1])
        if size >= TOGETHER:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, cut_words: bool = True) -> DataFrame:
    """``id_col``, ``ids`` (binary, little-endian unsigned 32-bit ids) per row.

    A null text counts as empty, an empty text has no ids; repeated rows and
    null ids stay rows of their own; other columns are not carried.
    ``vocabulary``: path of the file on every executor (None: the public
    byte-level one).  ``cut_words=False`` leaves words of up to ``CACHED_LENGTH``
    characters to tiktoken uncut: the same ids for less time, for operators
    that only need ids.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = byte_bpe(_vocabulary(vocabulary), cut_words)
        for b in batches:
            rows = 1000 if cut_words else 4000
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                ids: list[bytes] = []
                for texts in together(part.column(1)):
                    ids += map(bpe.encode, texts) if cut_words else bpe.encode_many(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(run), f"`{id_col}` {id_type}, ids binary")


def decode_ids(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``id_col``, ``n_tokens``, ``ids_text`` (decimal, comma-joined) and
    ``decoded`` per row of packed ids; null ids decode to an empty text."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = byte_bpe(_vocabulary(vocabulary))
        for b in batches:
            for at in range(0, b.num_rows, 200):      # ids written out are several times the text
                part = b.slice(at, 200)
                ids = [x.as_py() or b"" for x in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([bpe.digits(x) for x in ids], pa.string()),
                     pa.array([bpe.decode(x) for x in ids], pa.string())],
                    names=[id_col, "n_tokens", "ids_text", "decoded"])

    return df.select(F.col(id_col), F.col(ids_col)).mapInArrow(
        tidy(run), f"`{id_col}` {id_type}, n_tokens long, ids_text string, decoded string")


def token_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
                 end_id: int | None = 2, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Documents as token pieces of at most ``capacity`` ids.

    Each document is its ids and then ``end_id``; longer ones are cut into full
    pieces, only the first being shorter.  Columns: ``id_col``, ``piece`` (from
    0), ``start``, ``length``, ``ids_crc32`` and, with ``with_ids``, the packed
    ``ids``.  A null or empty text is the end id alone (without one it has no
    piece); repeated rows each give their pieces.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    end = b"" if end_id is None else np.asarray([end_id], "<u4").tobytes()

    def run(batches):
        bpe = byte_bpe(_vocabulary(vocabulary), False)      # only the ids count here
        for b in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for key, text in zip(b.column(0), b.column(1)):
                ids = bpe.encode(text.as_py() or "") + end
                n = len(ids) // 4
                start = 0
                for piece in range(-(-n // capacity)):
                    length = (n % capacity or capacity) if piece == 0 else capacity
                    own = ids[4 * start:4 * (start + length)]
                    for out, v in zip(rows, (key.as_py(), piece, start, length, zlib.crc32(own), own if with_ids else None)):
                        out.append(v)
                    start += length
            arrays = [pa.array(rows[0], b.schema.field(0).type), pa.array(rows[1], pa.int32()), *(pa.array(r, pa.int64()) for r in rows[2:5])]
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(rows[5], pa.binary())] * with_ids, names=names + ["ids"] * with_ids)

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(
        tidy(run), f"`{id_col}` {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)
