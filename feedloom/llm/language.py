"""Language identification by cross-parsing against labelled text.

For each language a suffix automaton of some labelled text is built: it follows any substring of it. A document is cut
into phrases, each the longest string from where the last one ended that the language's text contains. The closer the
two are, the longer the matches, so the language that needs the fewest phrases per character wins (cross-parsing,
which estimates the entropy of one text under another's statistics).

Automata become one hash table of transitions, whose size goes by the labelled text and not by how many letters there
are. A task then walks thousands of pieces of text through all languages at once, one
character of each per step.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm import blocks

UNDETERMINED = "und"
#: Bounds of the labelled sample: languages, those with most documents first, documents per language, and characters of each.
SAMPLE_LANGUAGES = 256
SAMPLE_DOCUMENTS = 40
SAMPLE_CHARACTERS = 1000
#: Places of a long text that its characters are taken from.
SPOTS = 4
#: How far from its own language's phrases per letter towards another's a text may lie and still count as written in it.
ODD = 0.8
#: Characters after which a parse starts anew, so that long texts keep many lanes busy.
PIECE = 512


def held_out() -> Column:
    """Whether a document is kept from learning: the CRC-32 of its id as text is divisible by 5. A null id counts as
    an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of each state of the minimal automaton of all substrings; state 0 is the start."""
    step, link, length, last = [{}], [-1], [0], 0
    for symbol in text:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at != -1 and symbol not in step[at]:
            step[at][symbol] = new
            at = link[at]
        if at != -1:
            to = step[at][symbol]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(step)
                step.append(dict(step[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at != -1 and step[at].get(symbol) == to:
                    step[at][symbol] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return step


@dataclass
class Model:
    """``codes`` maps code points to symbols (0: no letter), of which there are ``width``. ``keys`` and ``to`` are the
    hash table of all automata: where a state (times ``width``, plus the symbol) leads; ``starts`` has the same of each automaton's root. ``limit`` is the number of phrases per letter from which a text is in none of the languages."""

    languages: list[str]
    codes: np.ndarray
    width: int
    keys: np.ndarray
    to: np.ndarray
    roots: np.ndarray
    starts: np.ndarray
    limit: float = np.inf


def _slot(key: np.ndarray, slots: int) -> np.ndarray:
    """Where the search for a key begins in a table of ``slots``, a power of two."""
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - slots.bit_length())).astype(np.int64)


def _hashed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A table of distinct keys with linear probing, a quarter full at most; free slots hold -1."""
    slots = 1 << max(1, (4 * len(key)).bit_length())
    keys, to = np.full(slots, -1, np.int64), np.zeros(slots, np.int32)
    slot = _slot(key, slots)
    left = np.arange(len(key))
    while len(left):
        free = left[keys[slot[left]] < 0]
        keys[slot[free]] = key[free]
        left = left[keys[slot[left]] != key[left]]
        slot[left] = (slot[left] + 1) % slots
    to[slot] = value
    return keys, to


def _follow(model: Model, state: np.ndarray, symbol: np.ndarray, home: np.ndarray) -> np.ndarray:
    """Where states lead; back to their root where a symbol leads nowhere."""
    key = state.astype(np.int64) * model.width + symbol
    slot = _slot(key, len(model.keys))
    found = model.keys[slot]
    out = np.where(found == key, model.to[slot], home)
    left = np.nonzero((found != key) & (found >= 0))
    key, slot = key[left], slot[left]
    while len(slot):
        slot = (slot + 1) % len(model.keys)
        found = model.keys[slot]
        hit = found == key
        out[tuple(x[hit] for x in left)] = model.to[slot[hit]]
        on = ~hit & (found >= 0)
        left, key, slot = tuple(x[on] for x in left), key[on], slot[on]
    return out


def _symbols(text: str, codes: np.ndarray) -> np.ndarray:
    """Letters as symbols; anything between them is one separator."""
    found = codes[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    return found[(found > 0) | np.r_[True, found[:-1] > 0][: len(found)]]


def build(samples: dict[str, list[str]]) -> Model:
    """The model of some texts per language."""
    letters = sorted({c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha()})
    of = {c: i + 1 for i, c in enumerate(letters)}
    other = len(of) + 1
    codes = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            codes[point] = of.get(low, other)
    width = other + 1
    languages = sorted(samples)
    starts = np.zeros((len(languages), width), np.int32)
    keys, to, roots, at = [], [], [], 0
    for i, language in enumerate(languages):
        text = [s for t in samples[language] for s in [0, *_symbols(t, codes).tolist()]]
        step = suffix_automaton(text)
        # Letters that no labelled text has in lower case lead nowhere.
        edges = [(state, symbol, end) for state, moves in enumerate(step) for symbol, end in moves.items() if symbol != other]
        state, symbol, end = np.array(edges, np.int64).reshape(-1, 3).T
        keys.append((state + at) * width + symbol)
        to.append(end + at)
        starts[i] = at
        starts[i, symbol[state == 0]] = end[state == 0] + at
        roots.append(at)
        at += len(step)
    table = _hashed(*(np.concatenate([np.empty(0, np.int64), *x]) for x in (keys, to)))
    return Model(languages, codes, width, *table, np.array(roots, np.int32), starts)


def phrases(pieces: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """Phrases each piece needs in each language. ``pieces`` has a row per piece, longest first, and a column per
    position."""
    lanes = len(pieces)
    root = np.repeat(model.roots[:, None], lanes, axis=1)
    state, count = root.copy(), np.zeros((len(model.roots), lanes), np.int32)
    active = np.searchsorted(-lengths, -np.arange(pieces.shape[1]), "left")
    for at in range(pieces.shape[1]):
        n = active[at]
        if not n:
            break
        symbol, home = pieces[:n, at].astype(np.int64), root[:, :n]
        moved = _follow(model, state[:, :n], symbol, home)
        stuck = moved == home
        # A phrase ended before this symbol; the next one starts with it. At the start there was none to end.
        count[:, :n] += stuck & (state[:, :n] != home)
        again = model.starts[:, symbol]
        moved = np.where(stuck, again, moved)
        # Symbols the language does not have are phrases of their own.
        count[:, :n] += stuck & (again == home)
        state[:, :n] = moved
    return count + (state != root)


def _rates(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Phrases per letter of each text in each language, and how many letters and separators each has."""
    rows, pieces, sizes = [], [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        symbols = _symbols(text, model.codes) if text else np.empty(0, np.uint32)
        if symbols.any():
            sizes[i] = len(symbols)
            cuts = [symbols[a : a + PIECE] for a in range(0, len(symbols), PIECE)]
            pieces += cuts
            rows += [i] * len(cuts)
    total = np.zeros((len(model.languages), len(texts)))
    if pieces and model.languages:
        lengths = np.array([len(p) for p in pieces])
        order = np.argsort(-lengths, kind="stable")
        grid = np.zeros((len(pieces), lengths[order[0]]), np.uint32)
        for lane, piece in enumerate(order.tolist()):
            grid[lane, : lengths[piece]] = pieces[piece]
        counts = phrases(grid, lengths[order], model)
        for language in range(len(model.languages)):
            np.add.at(total[language], np.array(rows)[order], counts[language])
    return total / np.maximum(sizes, 1), sizes


def _limit(model: Model, more: dict[str, list[str]]) -> float:
    """Phrases per letter from which a text is in none of the languages: between what further labelled texts need in their own language and in the
    nearest other one, ``ODD`` of the way. Without other languages or texts there is none."""
    own, foreign = [], []
    for i, language in enumerate(model.languages):
        texts = more.get(language, [])
        if len(model.languages) > 1 and texts:
            rate, sizes = _rates(texts, model)
            rate = rate[:, sizes > 0]
            own += rate[i].tolist()
            foreign += np.delete(rate, i, axis=0).min(axis=0).tolist()
    if not own:
        return np.inf
    return float(np.mean(own) + ODD * max(np.mean(foreign) - np.mean(own), 0.0)) if np.mean(foreign) > np.mean(own) else np.inf


def _predict(batches: Iterator[pa.RecordBatch], held, carried: list[str]) -> Iterator[pa.RecordBatch]:
    model = Model(**held.value)
    for batch in batches:
        texts = batch.column("text")
        pred, score, fits = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
        for begin, stop in blocks.slices(batch.column("text")):
            rate, sizes = _rates(texts.slice(begin, stop - begin).to_pylist(), model)
            if not sizes.any() or not model.languages:
                continue
            best = np.argmin(rate, axis=0)
            ranked = np.sort(rate, axis=0)
            second = ranked[1] if len(model.languages) > 1 else np.maximum(ranked[0], 1.0)
            margin = 1 - ranked[0] / np.maximum(second, 1e-9)
            # Few letters may be off by chance.
            allowed = np.minimum(model.limit, 1.0) * sizes
            fits[begin:stop] = (sizes > 0) & ((ranked[0] * sizes < allowed + np.sqrt(allowed)) | np.isinf(model.limit))
            for i in np.flatnonzero(sizes).tolist():
                pred[begin + i] = model.languages[best[i]]
                score[begin + i] = min(1.0, max(0.0, float(margin[i])))
        arrays = [*(batch.column(c) for c in carried), pa.array(pred), pa.array(score), pa.array(fits)]
        yield pa.RecordBatch.from_arrays(arrays, names=[*carried, "lang_pred", "score", "fits"])


def _spread(text: Column, draw: Column, characters: int) -> Column:
    """A text's characters from several places all over it, each place drawn from its share of the text by hash; a short text whole."""
    n, piece = F.length(text), characters // SPOTS
    share = F.floor(n / SPOTS).cast("int")
    parts = [F.substring(text, F.lit(k) * share + F.pmod(F.xxhash64(draw, F.lit(k)), share - piece + 1).cast("int") + 1, F.lit(piece)) for k in range(SPOTS)]
    return F.when(n <= characters, F.array(text)).otherwise(F.array(*parts))


def learn(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, characters: int = SAMPLE_CHARACTERS, languages: int = SAMPLE_LANGUAGES) -> Model:
    """The model of a table with ``doc_id``, ``text`` and ``lang``, from at most ``documents`` texts per language,
    drawn by a hash of the id, and at most ``characters`` of each, from several places all over the text.

    As many further texts per language say how well a text must fit to be in one of the languages at all (see :func:`predict`). Of more than
    ``languages`` labels those with most texts are learned. Rows held out (see :func:`held_out`), without a language or without text are no
    part of it. Texts that give the same characters count once.
    """
    labelled = docs.where(~held_out() & F.col("lang").isNotNull() & (F.length("text") > 0))
    draw = F.xxhash64("doc_id", "text")
    parts = _spread(F.col("text"), draw, characters)
    labelled = labelled.select(F.col("lang").cast("string").alias("lang"), parts.alias("parts"), draw.alias("draw"))
    most = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    # The first rows of a window are kept task by task before the shuffle.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "parts"))
    first = labelled.withColumn("place", place).where(F.col("place") <= 8 * documents)
    sample = first.join(most.select("lang"), "lang", "left_semi").orderBy("lang", "place").collect()
    texts: dict[str, dict[tuple[str, ...], None]] = {}
    for row in sample:
        held = texts.setdefault(row.lang, {})
        if len(held) < 2 * documents:
            held[tuple(row.parts)] = None
    model = build({language: [p for parts in list(held)[:documents] for p in parts] for language, held in texts.items()})
    model.limit = _limit(model, {language: [" ".join(parts) for parts in list(held)[documents:]] for language, held in texts.items()})
    return model


def predict(docs: DataFrame, model: Model, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``held_out``, the columns to ``keep``, ``lang_pred``, ``score`` and ``fits`` of every row; only the text decides.

    ``score`` is by how much the second language needs more phrases than the first, as a share of the second's (0 to
    1). ``fits`` says whether the text is as near to its language as labelled texts are, and not as far as texts of another language, by more than
    chance does to so few letters; a text in a language that was not learned, or in none, does not fit. A text that is null, empty or has no letter is ``und`` with score 0 and does not fit, as is every text if nothing was
    learned; ties go to the language first in order. With one language the score is held against one phrase per letter, and every text with a letter fits. Each
    row is judged by itself, so repeated and null ids give a row each; an empty table gives none. Texts are parsed
    whole, in pieces of ``PIECE`` letters. Other columns are ignored.
    """
    # Plain arrays: a class would have to be imported on the executors.
    held = docs.sparkSession.sparkContext.broadcast(dict(vars(model)))
    rows = docs.select("doc_id", held_out().alias("held_out"), *keep, *([] if "text" in keep else ["text"]))
    carried = ["doc_id", "held_out", *keep]
    schema = ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried] + ["lang_pred string", "score double", "fits boolean"])
    return rows.mapInArrow(lambda b: _predict(b, held, carried), schema)
