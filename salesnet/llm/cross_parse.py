"""Language ID by cross-parsing entropy with one suffix automaton per language."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesnet.llm.common import checkpointed, held_out, id_remainder, out_batch, pieces, text_of

FOLD, HELD = 3, 1
FIT_DOCS = 120        # documents per language, the smallest by hash
FIT_CHARS = 350       # characters of the passage taken of each of them
PART_LANGUAGES = 64   # languages of one broadcast; all languages are parsed, part by part
TABLE_BYTES = 256 << 20  # transition table of a group of languages parsed side by side
CHUNK = 512           # characters parsed in step with the other chunks
UNKNOWN = "und"
_NOT_LETTERS = r"[^\pL]+"


def _letters(text: pa.Array) -> pa.Array:
    """Lower case, everything but letters as one space."""
    return pc.replace_substring_regex(pc.utf8_lower(text), _NOT_LETTERS, " ")


def automaton_edges(s: list[int]) -> tuple[int, np.ndarray]:
    """States of the suffix automaton of ``s`` and its transitions (from, symbol, to), sorted
    (state 0 is the start and never a target)."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in s:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return len(nexts), np.array([(state, c, to[c]) for state, to in enumerate(nexts) for c in sorted(to)],
                                dtype=np.int32).reshape(-1, 3)


def suffix_automaton(s: list[int], alphabet: int) -> np.ndarray:
    """Transition table (states x alphabet) of the suffix automaton of ``s``; 0 means none."""
    states, edges = automaton_edges(s)
    table = np.zeros((states, alphabet), dtype=np.int32)
    table[edges[:, 0], edges[:, 1]] = edges[:, 2]
    return table


class CrossParser:
    """The automata of some languages; texts are parsed greedily into longest matches.

    Languages of near alphabets form a group with one table of ``TABLE_BYTES`` at most, so
    they advance side by side; a language whose own table is larger (thousands of letters)
    is looked up in its sorted transitions.  With several groups one table is held at a time."""

    def __init__(self, texts: dict[str, list[str]]):
        self.languages = sorted(texts)
        cleaned = ["\n".join(_letters(pa.array(texts[k], type=pa.string())).to_pylist()) for k in self.languages]
        self.letters = [sorted(set(t)) for t in cleaned]
        self.edges = []
        for own, t in zip(self.letters, cleaned):
            code = {c: i for i, c in enumerate(own)}
            self.edges.append(automaton_edges([code[c] for c in t]))
        self.groups: list[list[int]] = []
        joint, states = set(), 0
        for k in sorted(range(len(cleaned)), key=lambda k: (self.letters[k][len(self.letters[k]) // 2:][:1], k)):
            more = joint | set(self.letters[k])
            if not self.groups or 4 * (states + self.edges[k][0]) * (len(more) + 1) > TABLE_BYTES:
                self.groups.append([])
                more, states = set(self.letters[k]), 0
            self.groups[-1].append(k)
            joint, states = more, states + self.edges[k][0]

    def prepare(self, group: int):
        """(symbol by code point, alphabet, start states, lookup of (state, symbol): the next
        state or -1) of a group, with states numbered through the group."""
        if getattr(self, "_ready", (None,))[0] == group:
            return self._ready[1]
        self._ready = (None,)  # the table before is freed first
        own = self.groups[group]
        letters = sorted(set().union(*(self.letters[k] for k in own)))
        alphabet = len(letters) + 1  # 0: a letter no language of the group has
        code = {c: i + 1 for i, c in enumerate(letters)}
        symbol = np.zeros(0x110000, dtype=np.uint16)
        for c, i in code.items():
            symbol[ord(c)] = i
        starts = np.cumsum([0, *[self.edges[k][0] for k in own]])
        keys, to = [], []
        for k, start in zip(own, starts):
            edges = self.edges[k][1]
            codes = np.array([code[c] for c in self.letters[k]], dtype=np.int64)
            keys.append((edges[:, 0] + start) * alphabet + codes[edges[:, 1]])
            to.append((edges[:, 2] + start).astype(np.int32))
        keys, to, size = np.concatenate(keys), np.concatenate(to), int(starts[-1]) * alphabet
        if 4 * size <= TABLE_BYTES:
            table = np.full(size, -1, dtype=np.int32)
            table[keys] = to
            lookup = table.__getitem__
        else:
            keys, to = np.append(keys, size), np.append(to, np.int32(-1))

            def lookup(at: np.ndarray) -> np.ndarray:
                i = np.searchsorted(keys, at)
                return np.where(keys[i] == at, to[i], np.int32(-1))
        self._ready = group, (symbol, alphabet, starts[:-1].astype(np.int32), lookup)
        return self._ready[1]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_ready"}

    def phrases(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrases per text and language, characters parsed, has a letter)."""
        clean = _letters(text)
        n = len(clean)
        lengths = pc.utf8_length(clean).to_numpy(zero_copy_only=False).astype(np.int64)
        lettered = pc.match_substring_regex(clean, r"\pL").to_numpy(zero_copy_only=False)
        points = np.frombuffer("".join(clean.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
        per = -(-lengths // CHUNK)
        owner = np.repeat(np.arange(n), per)
        begin = np.repeat(np.cumsum(lengths) - lengths, per) + (np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)) * CHUNK
        size = np.minimum(CHUNK, np.repeat(np.cumsum(lengths), per) - begin)
        order = np.argsort(-size, kind="stable")
        begin, size, owner = begin[order], size[order], owner[order]
        total = np.zeros((n, len(self.languages)), dtype=np.int64)
        for group, own in enumerate(self.groups):
            symbol, alphabet, starts, lookup = self.prepare(group)
            stream = symbol[points].astype(np.int64)
            count = np.zeros((len(starts), len(owner)), dtype=np.int32)
            state = np.repeat(starts[:, None], len(owner), axis=1)
            for i in range(int(size[0]) if len(size) else 0):
                live = int(np.searchsorted(-size, -i, side="left"))
                c = stream[begin[:live] + i]
                to = lookup(state[:, :live].astype(np.int64) * alphabet + c)
                dead = to < 0
                count[:, :live] += dead
                again = lookup((starts[:, None].astype(np.int64) * alphabet) + c[None, :])
                to = np.where(dead, np.where(again < 0, starts[:, None], again), to)
                state[:, :live] = to
            count += 1  # the phrase that the end of the chunk closes
            for j, k in enumerate(own):
                total[:, k] = np.bincount(owner, weights=count[j], minlength=n)
        return total, lengths, lettered


def fit_languages(docs: DataFrame) -> Iterator[CrossParser]:
    """Automata of at most ``FIT_DOCS`` x ``FIT_CHARS`` characters of labelled text for every
    language, ``PART_LANGUAGES`` at a time by name, from documents outside the held-out fold.
    The passage taken of a document is drawn by a hash over its whole text.  The choice per
    language is a limit inside the window, applied before the shuffle too."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (id_remainder("doc_id", FOLD) != HELD))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "t")
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.lit(1), F.ceil(F.length("text") / FIT_CHARS)))
    rows = (known.select("doc_id", "lang", F.substring("text", (drawn * FIT_CHARS + 1).cast("int"), F.lit(FIT_CHARS)).alias("t"))
            .withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= FIT_DOCS))
    rows = checkpointed(rows)
    names = sorted(r[0] for r in rows.select("lang").distinct().collect())
    for at in range(0, len(names), PART_LANGUAGES):
        part = names[at:at + PART_LANGUAGES]
        texts: dict[str, list[str]] = {k: [] for k in part}
        for r in rows.filter(F.col("lang").isin(part)).orderBy("lang", "_n").collect():
            texts[r["lang"]].append(r["t"])
        yield CrossParser(texts)


def identify_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document.

    The whole text is parsed greedily by every automaton into the longest pieces that
    occur in the language's sample; the language with the fewest phrases per character
    wins (ties: the first by name).  Long texts are parsed in chunks of ``CHUNK``
    characters, the same for every language, so thousands of chunks advance together and
    nothing is cut off.  ``score`` is the winner's share of a softmax over the phrase
    rates.  There is an automaton for every language with labelled text outside the
    held-out fold; they are broadcast ``PART_LANGUAGES`` at a time, and with several parts a
    task holds one of them at a time.  The time grows with the number of languages.

    NULL text and text without a letter give ``und`` with score 0, and so does a table
    without labelled text.  Rows without id are not held out and not learned from;
    repeated rows repeat; an empty table gives no rows; other columns are ignored.
    """
    context, names, shared = docs.sparkSession.sparkContext, [], []
    for parser in fit_languages(docs):
        names += parser.languages
        shared.append(context.broadcast(parser))
    names = np.array(names, dtype=object)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 2 << 20):
            if not len(names):
                n = batch.num_rows
                yield out_batch(schema, doc_id=batch.column(0), lang_pred=[UNKNOWN] * n, score=np.zeros(n))
                continue
            totals = []
            for part in shared:
                total, chars, lettered = part.value.phrases(text_of(batch))
                totals.append(total)
                if len(shared) > 1:
                    vars(part).pop("_value", None)  # read again from the task's broadcast file
            total = np.hstack(totals)
            rate = total / np.maximum(chars, 1)[:, None]
            best = rate.argmin(axis=1)
            odds = np.exp(-40.0 * (rate - rate.min(axis=1, keepdims=True)))
            share = 1.0 / odds.sum(axis=1)
            yield out_batch(schema, doc_id=batch.column(0), lang_pred=np.where(lettered, names[best], UNKNOWN).tolist(),
                            score=np.where(lettered, share, 0.0))

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out("doc_id", FOLD, HELD).alias("held_out"), "lang_pred", "score")
