"""Token ids of many texts at once, equal to the tokenizer's own.

The tokenizer normalises (composition, lower case), cuts a text by a fixed
pattern into runs of letters, single digits and runs of other signs, never
across white space, and gives each run its ids independently.  So the ids of a
text are those of its runs, and each different run needs encoding once.

Texts in Latin-1 (composed already, lower case by a table of 256) are cut and
looked up as byte arrays, a block of texts at a time.  Others, and those with
an apostrophe (contractions are cut apart), go through a cache of their
white-space separated chunks.  Texts with a special token's string, or with
separators that only Python counts as space, are encoded whole.
"""

from __future__ import annotations

import numpy as np

from vetline.llm import common as c

BLOCK_BYTES = 1 << 18       # text handled at once; its arrays take many times as much, in each Python worker
CACHED_RUNS = 1_000_000     # per Python worker, in arrays
CACHED_CHUNKS = 100_000
LONGEST = 64                # bytes of a run that is looked up by its hash
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def _classes() -> np.ndarray:
    out = np.full(256, _OTHER, np.uint8)
    for b in range(256):
        ch = chr(b)
        if ch.isspace() and not "\x1c" <= ch <= "\x1f":
            out[b] = _SPACE
        elif ch.isalpha():
            out[b] = _LETTER
        elif ch.isnumeric():
            out[b] = _NUMBER
    return out


CLASSES = _classes()
LOWER = bytes(ord(x) if len(x := chr(b).lower()) == 1 and ord(x) < 256 else b for b in range(256))

class TokenIds:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        vocab = self.tok.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocab.values()) + 1, bool)        # ids that end a run
        for token, i in vocab.items():
            self.last[i] = token.endswith("</w>")
        self._clear()
        self.chunks: dict[str, np.ndarray] = {}

    def _clear(self):
        self.known = np.zeros(0, np.uint64)         # run hashes, sorted
        self.starts, self.lens = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    # ---- any text -------------------------------------------------------------
    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def _chunked(self, text: str) -> np.ndarray:
        words = text.split()
        new = [w for w in dict.fromkeys(words) if w not in self.chunks]
        if len(self.chunks) + len(new) > CACHED_CHUNKS:
            self.chunks.clear()
            new = list(dict.fromkeys(words))
        for i in range(0, len(new), 4096):
            for w, e in zip(new[i:i + 4096], self.tok.encode_batch_fast(new[i:i + 4096], add_special_tokens=False)):
                self.chunks[w] = np.array(e.ids, np.uint32)
        return np.concatenate([self.chunks[w] for w in words]) if words else np.zeros(0, np.uint32)

    # ---- Latin-1 --------------------------------------------------------------
    def _encode_runs(self, runs: list[str]) -> list[np.ndarray]:
        """Ids of runs of letters or other signs, many per call."""
        out = []
        for i in range(0, len(runs), 500):
            some = runs[i:i + 500]
            ids = np.array(self.tok.encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some) and (not len(ids) or ends[-1] == len(ids)):
                out += np.split(ids, ends[:-1])
            else:
                out += [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(some, add_special_tokens=False)]
        return out

    def _learn(self, hashes: np.ndarray, runs: list[str]) -> None:
        got = self._encode_runs(runs)
        n = np.array([len(x) for x in got], np.int64)
        total = int(n.sum())
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used:self.used + total] = np.concatenate(got)
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.starts = np.insert(self.starts, at, self.used + np.cumsum(n) - n)
        self.lens = np.insert(self.lens, at, n)
        self.used += total

    def _latin(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of lower-cased Latin-1 texts."""
        raw = b" ".join(texts) + b" "
        buf = np.frombuffer(raw, np.uint8)
        kind = CLASSES[buf]
        cut = np.append(True, (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER))
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(buf))
        some = kind[starts] != _SPACE
        starts, ends = starts[some], ends[some]
        h = c.Spans(c.byte_values(buf))(starts, ends)
        long = np.flatnonzero(ends - starts > LONGEST)
        h[long] = np.uint64(0)
        different, first, number = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, different)
        there = self.known[np.minimum(at, max(len(self.known) - 1, 0))] == different if len(self.known) else np.zeros(len(different), bool)
        there |= different == 0
        if not there.all():
            new = np.flatnonzero(~there)
            if len(self.known) + len(new) > CACHED_RUNS:
                self._clear()
                new = np.flatnonzero(different != 0)
            a, b = starts[first[new]], ends[first[new]]
            self._learn(different[new], [raw[i:j].decode("latin-1") for i, j in zip(a.tolist(), b.tolist())])
            at = np.searchsorted(self.known, different)
        zero = different == 0
        row = np.minimum(at, max(len(self.known) - 1, 0))
        n, lo = (np.where(zero, 0, self.lens[row])[number], self.starts[row][number]) if len(self.known) else (np.zeros(len(number), np.int64),) * 2
        flat = self.flat
        if len(long):       # runs too long for the table
            own = self._encode_runs([raw[i:j].decode("latin-1") for i, j in zip(starts[long].tolist(), ends[long].tolist())])
            flat = np.concatenate([self.flat[:self.used], *own])
            n, lo = n.copy(), lo.copy()
            n[long] = [len(x) for x in own]
            lo[long] = self.used + np.cumsum(n[long]) - n[long]
        upto = np.cumsum(n)
        total = int(upto[-1]) if len(upto) else 0
        ids = flat[np.arange(total) + np.repeat(lo - (upto - n), n)]
        # token counts up to each text's end
        edge = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
        edges = np.append(0, upto)[edge]
        return np.split(ids, edges[:-1])

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text (null: none), in order."""
        out: list = [None] * len(texts)
        queue, held = [], 0
        for i, text in enumerate(texts):
            text = text or ""
            if any(s in text for s in self.special):
                out[i] = self._whole(text)
                continue
            try:
                latin = text.encode("latin-1").translate(LOWER) if "'" not in text else None
            except UnicodeEncodeError:
                latin = None
            if latin is not None:
                queue.append((i, latin))
                held += len(latin)
            elif any(x in text for x in "\x1c\x1d\x1e\x1f"):
                out[i] = self._whole(text)
            else:
                out[i] = self._chunked(text)
            if held > BLOCK_BYTES:
                for (k, _), ids in zip(queue, self._latin([b for _, b in queue])):
                    out[k] = ids
                queue, held = [], 0
        for (k, _), ids in zip(queue, self._latin([b for _, b in queue]) if queue else ()):
            out[k] = ids
        return out
