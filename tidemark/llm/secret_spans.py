r"""Secrets in texts: three fixed patterns, and a linear-chain conditional random field for what they miss.

A text is cut into words, marks and the white space behind them. Every token is tagged as the begin of a secret, the inside
of one or outside, from its own shape (letter classes, length, changes between letters and digits, variety), from the words
around it (three before, two behind) and from features of the whole text (length, shares of digits, capitals and marks).
Weights are hashed and trained in numpy by the gradient of the exact likelihood (forward and backward sums); the best tags
are found by Viterbi.

Learning takes windows of ``WINDOW`` tokens from at most ``SAMPLE_TEXTS`` different texts with a match and as many without,
smallest hashes first. Tags are the matches of the patterns; windows of the second kind are used once as they are and once
with a random secret and a harmless look-alike planted in them, so that the model also knows forms that the patterns lack. Everything else reads all of every text.

Decoding is exact and reads a text in blocks: a token whose score as outside exceeds both others by more than any change of
transitions can give back is outside on the best path, so paths are searched only between such tokens.

Defined cases: a null text is the empty text; empty texts have no spans; rows are read one by one, whatever repeats and
whatever their ids; offsets count code points, ends are exclusive; a tagged span that touches a pattern's match is the same
secret and is not added; only the text is read, and columns keep their names; an empty table gives no rows and a
model without a sample adds nothing.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import saved, text_column

KINDS = ("assign", "access", "hex", "crf")
#: The patterns; letters of the first group stand in either case.
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Any text with a match of a pattern has one of this, which Spark can filter by.
ROUGH = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"

SAMPLE_TEXTS = 800
WINDOWS_PER_TEXT = 2
WINDOW = 32
PLACES = 1 << 15
STEPS = 60
#: Longer tokens are known by their shape alone.
LONGEST_WORD = 16
OFFSETS = (-3, -2, -1, 0, 1, 2)
BEFORE, BEHIND = 3, 2
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
#: Characters read at once, and tokens remembered.
BLOCK = 1 << 18
REMEMBERED = 200_000

_TOKEN = re.compile(r"[^\s\"'`=:,;<>(){}\[\]|!?#$%&*@]+\s*|[\"'`=:,;<>(){}\[\]|!?#$%&*@]\s*|\s+").findall
_CUT = re.compile(r"\s(?=\S)").search
_CLASSES = str.maketrans({**dict.fromkeys(map(chr, range(97, 123)), "a"), **dict.fromkeys(map(chr, range(65, 91)), "A"), **dict.fromkeys("0123456789", "0")})
_RUNS = re.compile(r"(.)\1*", re.DOTALL)
_HEXES = re.compile(r"[0-9a-f]+|[0-9A-F]+").fullmatch
_NAMED = ("password", "passwd", "secret", "token", "apikey", "api_key")
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")


# --- patterns ---------------------------------------------------------------------------------


def _assigned(text: str) -> Iterator[re.Match]:
    low = text.lower()
    if any(name in low for name in _NAMED):  # far cheaper than the pattern
        yield from (m for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"])


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Matches of the patterns as (start, end, kind), in order of start and kind."""
    found = [(m.start(), m.end(), "assign") for m in _assigned(text)]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    # Runs of this class are maximal, so the short ones can be left out by the pattern itself.
    found += [(m.start(), m.end(), "hex") for m in _LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _values(text: str) -> list[tuple[int, int]]:
    """The secret parts of the matches, joined where they overlap."""
    found = [m.span(2) for m in _assigned(text)]
    found += [span[:2] for span in base_spans(text) if span[2] != "assign"]
    out: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


# --- features ---------------------------------------------------------------------------------


def _kind(core: str, classes: str) -> str:
    used = set(classes)
    if core and _HEXES(core) and "0" in used and len(used) > 1:
        return "hex"
    return "".join(sorted(c if c in "aA0" else "-" for c in used))[:4]


def _bucket(share: float) -> int:
    return min(int(share * 5), 4)


def shape(core: str) -> tuple:
    """Kind, size, changes of class, share of digits, variety and first classes of a token."""
    size, variety = min(len(core).bit_length(), 7), _bucket(len(set(core)) / max(len(core), 1))
    if core.isalpha():  # most words, letters of any alphabet
        if core.islower():
            return "a", size, 1, 0, variety, "a"
        if core[1:].islower():
            return "Aa", size, 2, 0, variety, "Aa"
    classes = core.translate(_CLASSES)
    runs = [m[1] if m[1] in "aA0" else "-" for m in _RUNS.finditer(classes[:256])]
    digits = _bucket(classes.count("0") / max(len(core), 1))
    return _kind(core, classes), size, min(len(runs), 9), digits, variety, "".join(runs[:6])


def shape_features(of: tuple) -> list[str]:
    """What the shape of a token says about itself."""
    kind, size, turns, digits, variety, runs = of
    return ["one", f"n{size}", f"k{kind}", f"kn{kind}|{size}", f"t{turns}", f"tn{turns}|{size}", f"d{digits}|{size}", f"v{variety}|{size}", f"s{runs}"]


def word_of(core: str) -> str:
    """The form under which short tokens are known by name; empty for long ones."""
    return core.lower() if len(core) <= LONGEST_WORD else ""


def text_features(text: str) -> list[str]:
    """What the whole text says about its tokens."""
    raw = text.encode("utf-8", "surrogatepass")
    size = max(len(raw), 1)
    share = lambda chars: min((len(raw) - len(raw.translate(None, chars))) * 200 // size, 60).bit_length()
    return [f"N{size.bit_length()}", f"D{share(b'0123456789')}", f"C{share(bytes(range(65, 91)))}", f"M{share(b'=:{}<>;')}"]


def _place(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % PLACES


def shape_places(of: tuple) -> list[list[int]]:
    """Weight places of a shape for the token that lies ``-offset`` away, by offset."""
    return [[_place(f"{o}{f}") for f in (shape_features(of) if o == 0 else [f"k{of[0]}"])] for o in OFFSETS]


def word_places(word: str) -> list[int]:
    """The same for a word known by name, one place an offset."""
    return [_place(f"{o}w{word}") for o in OFFSETS]


# --- model ------------------------------------------------------------------------------------


@dataclass
class SecretModel:
    """Weights by place and tag, and transitions from tag to tag; a text begins and ends outside."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros((PLACES, 3), np.float32))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((3, 3)))
    words: frozenset[str] = frozenset()
    trained: bool = False

    def slack(self) -> float:
        """What changing the tag of one token to outside can cost in transitions at most."""
        enter = (self.moves - self.moves[:, :1]).max()
        leave = (self.moves - self.moves[:1, :]).max()
        return float(max(enter, 0) + max(leave, 0))


class _Table(dict):
    """Token with its white space -> row of scores, by offset and tag. Rows belong to pairs of shape and known word."""

    def __init__(self, model: SecretModel):
        super().__init__({"": 0})
        self._model, self._pairs = model, {None: 0}
        self.rows = np.zeros((64, len(OFFSETS) * 3), np.float32)

    def __missing__(self, token: str) -> int:
        core = token.rstrip()
        word = word_of(core)
        pair = (shape(core), word if word in self._model.words else "") if core else None
        row = self._pairs.get(pair)
        if row is None:
            row = self._pairs[pair] = len(self._pairs)
            if row >= len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            weights = self._model.weights
            scores = np.stack([weights[places].sum(0) for places in shape_places(pair[0])])
            if pair[1]:
                scores = scores + weights[word_places(pair[1])]
            self.rows[row] = scores.ravel()
        self[token] = row
        return row

    def forget(self) -> None:
        """Drop the remembered tokens, and the rows where they are many."""
        self.clear()
        self[""] = 0
        if len(self._pairs) > REMEMBERED:
            self._pairs = {None: 0}


def _text_blocks(text: str) -> Iterator[str]:
    start = 0
    while start < len(text):
        cut = _CUT(text, start + BLOCK) if start + BLOCK < len(text) else None
        end = cut.end() if cut else len(text)
        yield text[start:end]
        start = end


class Tagger:
    """Finds tagged spans of texts with a trained model."""

    def __init__(self, model: SecretModel):
        self._model, self._table, self._slack = model, _Table(model), model.slack()

    def _scores(self, ids: np.ndarray, first: int, last: int, offset: np.ndarray) -> np.ndarray:
        rows, out = self._table.rows, np.broadcast_to(offset, (last - first, 3)).copy()
        for o, shift in enumerate(OFFSETS):
            out += rows[ids[first + shift : last + shift], 3 * o : 3 * o + 3]
        return out

    def open_tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number, start, end and scores of the tokens that need not be outside."""
        places = [_place(f) for f in text_features(text)]
        offset = self._model.weights[places].sum(0)
        number = at = 0
        carried: list[str] = [""] * BEFORE
        carried_at: list[int] = [0] * BEFORE
        found = []
        blocks = _text_blocks(text)
        block = next(blocks, None)
        while block is not None:
            following = next(blocks, None)
            if len(self._table) > REMEMBERED:
                self._table.forget()
            fresh = _TOKEN(block)
            tokens = carried + fresh
            starts = np.concatenate([np.array(carried_at, np.int64), at + np.cumsum([0, *map(len, fresh)])])[: len(tokens)]
            at += len(block)
            if following is None:
                tokens = tokens + [""] * BEHIND
            ids = np.fromiter(map(self._table.__getitem__, tokens), np.int64, len(tokens))
            last = max(len(tokens) - BEHIND, BEFORE)
            scores = self._scores(ids, BEFORE, last, offset)
            loose = np.flatnonzero(scores[:, OUTSIDE] - scores[:, 1:].max(1) <= self._slack) if len(scores) else np.zeros(0, np.int64)
            inner = starts[BEFORE:last]
            sizes = np.array([len(tokens[BEFORE + k].rstrip()) for k in loose], np.int64)
            found.append((number + loose, inner[loose], inner[loose] + sizes, scores[loose]))
            number += last - BEFORE
            carried = tokens[last - BEFORE :]
            carried_at = starts[last - BEFORE :].tolist()
            block = following
        if not found:
            empty = np.zeros(0, np.int64)
            return empty, empty, empty, np.zeros((0, 3))
        return tuple(map(np.concatenate, zip(*found)))

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Tagged spans of a text."""
        if not self._model.trained:
            return []
        numbers, starts, ends, scores = self.open_tokens(text)
        if not len(numbers):
            return []
        out: list[tuple[int, int]] = []
        cuts = np.flatnonzero(np.diff(numbers) > 1) + 1
        for place, part in zip(np.split(np.arange(len(numbers)), cuts), np.split(scores, cuts)):
            tags = viterbi(part, self._model.moves)
            for k, tag in zip(place, tags):
                if tag == BEGIN or (tag == INSIDE and (not out or k == place[0] or previous == OUTSIDE)):
                    out.append((int(starts[k]), int(ends[k])))
                elif tag == INSIDE:
                    out[-1] = (out[-1][0], int(ends[k]))
                previous = tag
        return out


def viterbi(scores: np.ndarray, moves: np.ndarray) -> list[int]:
    """Best tags of a stretch between tokens outside; ties go to the tag that comes first."""
    best = moves[OUTSIDE] + scores[0]
    back = []
    for score in scores[1:]:
        through = best[:, None] + moves
        back.append(through.argmax(0))
        best = through.max(0) + score
    tag = int((best + moves[:, OUTSIDE]).argmax())
    tags = [tag]
    for step in reversed(back):
        tag = int(step[tag])
        tags.append(tag)
    return tags[::-1]


# --- training ---------------------------------------------------------------------------------


def _windows(text: str, spans: list[tuple[int, int]], order: int) -> list[tuple[list[str], list[int]]]:
    """Windows around matches, or anywhere in a text without one: tokens and tags, margins included."""
    tokens = _TOKEN(text)
    if not tokens:
        return []
    starts = np.cumsum([0, *map(len, tokens)])
    tags = [OUTSIDE] * len(tokens)
    firsts = []
    for start, end in spans:
        # A match may begin inside a token.
        first = int(np.searchsorted(starts, start, "right")) - 1
        last = int(np.searchsorted(starts, end, "left"))
        firsts.append(first)
        for k in range(first, max(last, first + 1)):
            tags[k] = BEGIN if k == first else INSIDE
    rng = random.Random(order)
    if firsts:
        middles = rng.sample(firsts, min(WINDOWS_PER_TEXT, len(firsts)))
    else:
        middles = [rng.randrange(len(tokens)) for _ in range(WINDOWS_PER_TEXT)]
    out = []
    for middle in middles:
        a = max(0, middle - rng.randrange(4, WINDOW - 8))
        while a and tags[a - 1] != OUTSIDE:
            a -= 1
        b = min(len(tokens), a + WINDOW)
        while b < len(tokens) and tags[b] == INSIDE and b < a + 2 * WINDOW:
            b += 1
        left, right = max(0, a - BEFORE), min(len(tokens), b + BEHIND)
        held = tokens[left:right]
        if sum(map(len, held)) <= 64 * WINDOW:
            marked = [tag if a <= k < b else -1 for k, tag in zip(range(left, right), tags[left:right])]
            out.append((held, marked))
    return out


def sample_windows(documents: DataFrame, texts: int = SAMPLE_TEXTS) -> list[tuple]:
    """(has a match, hash, number, tokens, tags, text features) from ``texts`` different texts of each kind."""
    read = documents.select(text_column(documents, "text").alias("__text")).withColumns(
        {"__has": F.col("__text").rlike(ROUGH), "__hash": F.xxhash64("__text")}
    )
    marks = saved(read.select("__has", "__hash").distinct(), "secret-sample")
    lowest = [marks.filter(F.col("__has") == has).orderBy("__hash").limit(texts).select("__hash") for has in (True, False)]
    chosen = sorted({row["__hash"] for part in lowest for row in part.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, has, order in zip(*(c.to_pylist() for c in batch.columns)):
                spans = _values(text) if has else []
                features = text_features(text)
                rows += [(bool(spans), order, n, *w, features) for n, w in enumerate(_windows(text, spans, order))]
            columns = list(zip(*rows)) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    names = ["has", "hash", "nr", "tokens", "tags", "features"]
    kinds = [pa.bool_(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string())]
    schema = "has boolean, hash long, nr int, tokens array<string>, tags array<int>, features array<string>"
    drawn = read.filter(F.col("__hash").isin(chosen)).select("__text", "__has", "__hash").mapInArrow(run, schema)
    rows = drawn.dropDuplicates(["hash", "nr"]).collect()
    return sorted(((r.has, r.hash, r.nr, list(r.tokens), list(r.tags), list(r.features)) for r in rows), key=lambda r: r[:3])


_NAMES = "password passwd pwd secret token api_key apikey api-key access_key client_secret auth_token passphrase credential private_key bearer key".split()
_JOINS = (" = ", "=", ": ", ":", " ", ' = "', '="', ': "', "='", " => ")
_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def planted_secret(rng: random.Random) -> tuple[str, str, str]:
    """What stands before a secret, the secret, and what stands behind it."""
    draw = lambda chars, least, most: "".join(rng.choices(chars, k=rng.randint(least, most)))
    value = rng.choice(
        [
            lambda: draw("0123456789abcdef", 24, 64),
            lambda: draw("0123456789ABCDEF", 24, 64),
            lambda: draw(_ALNUM + "+/", 20, 60) + rng.choice(("", "=", "==")),
            lambda: draw(_ALNUM, 16, 44),
            lambda: draw(_ALNUM + "_-", 16, 44),
            lambda: draw(_ALNUM[:26], 4, 4) + draw(_ALNUM[:26] + "0123456789", 16, 16),
            lambda: draw(_ALNUM[26:52], 2, 4) + rng.choice("_-") + draw(_ALNUM, 24, 40),
            lambda: ".".join(draw(_ALNUM + "_-", 16, 40) for _ in range(3)),
        ]
    )()
    name, join = rng.choice(_NAMES), rng.choice(_JOINS)
    if rng.random() < 0.3:
        name = name.upper()
    if rng.random() < 0.25:  # without a name
        name, join = "", rng.choice(("", '"', "'"))
    return name + join, value, join[-1] + " " if join[-1:] in ("'", '"') else " "


def planted_look_alike(rng: random.Random) -> str:
    """Something harmless that is long, numeric or assigned."""
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    return rng.choice(
        [
            lambda: f"{word(6)}.{word(5)}{number(2)}@{word(7)}.example.com ",
            lambda: f"https://www.{word(8)}.org/{word(6)}/{word(9)}-{number(4)}.html ",
            lambda: number(rng.randint(6, 18)) + " ",
            lambda: f"+{number(2)} {number(3)} {number(4)}-{number(3)} ",
            lambda: f"20{number(2)}-0{number(1)}-1{number(1)} ",
            lambda: word(rng.randint(16, 30)) + " ",
            lambda: word(rng.randint(16, 30)).upper() + " ",
            lambda: f"{rng.choice(_NAMES)} {word(rng.randint(3, 9))} ",
            lambda: f"{word(5)} = {rng.choice((word(6), number(4)))} ",
            lambda: f"v{number(1)}.{number(2)}.{number(1)}-{word(4)} ",
            lambda: "/".join(word(rng.randint(3, 9)) for _ in range(4)) + " ",
            lambda: "_".join(word(rng.randint(3, 7)) for _ in range(4)) + " ",
        ]
    )()


def _with(tokens: list[str], tags: list[int], rng: random.Random, planted: tuple[str, str, str]) -> tuple[list[str], list[int]]:
    inner = [k for k, tag in enumerate(tags) if tag >= 0]
    place = rng.choice(inner)
    head, value, tail = (_TOKEN(part) if part else [] for part in planted)
    if value and tail and not tail[0].strip():
        value, tail = [*value[:-1], value[-1] + tail[0]], tail[1:]
    new = [*head, *value, *tail]
    marks = [OUTSIDE] * len(head) + [BEGIN, *[INSIDE] * (len(value) - 1)][: len(value)] + [OUTSIDE] * len(tail)
    return [*tokens[:place], *new, *tokens[place:]], [*tags[:place], *marks, *tags[place:]]


def training_rows(windows: list[tuple]) -> list[tuple[list[str], list[int], list[str]]]:
    """Tokens, tags (-1: margin) and text features, planted ones included."""
    rng, out = random.Random(5), []
    for has, _, _, tokens, tags, features in windows:
        out.append((tokens, tags, features))
        if not has:
            planted = _with(tokens, tags, rng, ("", "", planted_look_alike(rng)))
            out.append((*_with(*planted, rng, planted_secret(rng)), features))
    return out


def fit(rows: list[tuple[list[str], list[int], list[str]]], steps: int = STEPS) -> SecretModel:
    """Adam on the likelihood of the tags, all windows at once."""
    model = SecretModel()
    rows = [r for r in rows if any(t >= 0 for t in r[1])]
    if not any(BEGIN in r[1] for r in rows):
        return model
    names = Counter(w for tokens, _, _ in rows for w in {word_of(t.rstrip()) for t in tokens})
    words = frozenset(w for w, n in names.items() if w and n > 2)  # a window may come twice, once planted
    known: dict[tuple | None, int] = {None: 0}
    most = max(len(r[0]) for r in rows) + BEFORE + BEHIND
    ids = np.zeros((len(rows), most), np.int64)
    tags = np.full((len(rows), most), -1, np.int64)
    for k, (tokens, marks, _) in enumerate(rows):
        for n, (core, mark) in enumerate(zip([t.rstrip() for t in tokens], marks), BEFORE):
            word = word_of(core)
            ids[k, n] = known.setdefault((shape(core), word if word in words else "") if core else None, len(known))
            tags[k, n] = mark
    pairs = [
        (t, o, place)
        for pair, t in known.items() if pair
        for o, places in enumerate(shape_places(pair[0]))
        for place in (*places, *([word_places(pair[1])[o]] if pair[1] else []))
    ]
    token, side, place = map(np.array, zip(*pairs))
    slot = token * len(OFFSETS) + side
    by_text = np.array([[_place(f) for f in features] for _, _, features in rows])
    # Every window's inner tokens, moved to the left.
    inner = tags >= 0
    length = inner.sum(1)
    steps_at = np.argsort(~inner, axis=1, kind="stable")[:, : length.max()]
    row = np.arange(len(rows))[:, None]
    live = np.arange(length.max())[None, :] < length[:, None]
    gold = np.where(live, tags[row, steps_at], 0)
    around = np.stack([ids[row, np.clip(steps_at + o, 0, most - 1)] * len(OFFSETS) + k for k, o in enumerate(OFFSETS)], 2)
    weights, moves = np.zeros((PLACES, 3)), np.zeros((3, 3))
    first = {"w": np.zeros_like(weights), "m": np.zeros_like(moves)}
    second = {"w": np.zeros_like(weights), "m": np.zeros_like(moves)}
    size, n_rows, n_steps = len(known) * len(OFFSETS), len(rows), live.shape[1]
    for step in range(1, steps + 1):
        table = np.stack([np.bincount(slot, weights[place, tag], size) for tag in range(3)], 1)
        score = table[around].sum(2) + weights[by_text].sum(1)[:, None, :]
        marginal, pair = _sums(score, moves, live)
        error = -marginal
        error[np.arange(n_rows)[:, None], np.arange(n_steps)[None, :], gold] += 1
        error *= live[..., None]
        seen = np.zeros((size, 3))
        for tag in range(3):
            held = np.broadcast_to(error[:, :, None, tag], around.shape)
            seen[:, tag] = np.bincount(around.ravel(), held.ravel(), size)
        slope = np.stack([np.bincount(place, seen[slot, tag], PLACES) for tag in range(3)], 1)
        total = error.sum(1)
        for tag in range(3):
            slope[:, tag] += np.bincount(by_text.ravel(), np.repeat(total[:, tag], by_text.shape[1]), PLACES)
        turn = _gold_moves(gold, live) - pair
        for name, value, change, damp in (("w", weights, slope, 0.02), ("m", moves, turn, 0.02)):
            change = (change - damp * value) / n_rows
            first[name] = 0.9 * first[name] + 0.1 * change
            second[name] = 0.99 * second[name] + 0.01 * change**2
            value += 0.1 * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
    return SecretModel(weights.astype(np.float32), moves, words, True)


def _gold_moves(gold: np.ndarray, live: np.ndarray) -> np.ndarray:
    edge = np.zeros((len(gold), 1), np.int64)
    held = np.concatenate([edge, np.where(live, gold, OUTSIDE), edge], 1)
    valid = np.concatenate([live, np.zeros_like(live[:, :1])], 1) | np.concatenate([np.ones_like(live[:, :1]), live], 1)
    return np.bincount((held[:, :-1] * 3 + held[:, 1:])[valid], minlength=9).reshape(3, 3).astype(float)


def _sums(score: np.ndarray, moves: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tag marginals and expected transitions; windows begin and end outside. Sums are scaled step by step."""
    rows, steps, _ = score.shape
    jump = np.exp(moves)
    here = np.exp(score - score.max(2, keepdims=True))
    forward, backward = np.zeros((rows, steps, 3)), np.zeros((rows, steps, 3))
    scale = np.ones((rows, steps))
    now = np.repeat(jump[None, OUTSIDE], rows, 0) * here[:, 0]
    for t in range(steps):
        if t:
            now = np.where(live[:, t, None], (now @ jump) * here[:, t], now)
        total = now.sum(1)
        scale[:, t] = np.where(live[:, t], total, 1.0)
        now = np.where(live[:, t, None], now / total[:, None], now)
        forward[:, t] = now
    behind = np.repeat(jump[None, :, OUTSIDE], rows, 0)
    for t in range(steps - 1, -1, -1):
        backward[:, t] = behind
        into = here[:, t] * behind / scale[:, t, None]
        behind = np.where(live[:, t, None], into @ jump.T, behind)
    marginal = forward * backward
    whole = marginal.sum(2, keepdims=True)
    marginal = marginal / whole * live[..., None]
    into = here * backward / scale[..., None] / whole * live[..., None]
    pair = np.einsum("nta,ntb->ab", forward[:, :-1], into[:, 1:]) * jump
    pair[OUTSIDE] += marginal[:, 0].sum(0)
    last = marginal[np.arange(rows), live.sum(1) - 1]
    pair[:, OUTSIDE] += last.sum(0)
    return marginal, pair


def train(documents: DataFrame, texts: int = SAMPLE_TEXTS) -> SecretModel:
    """A model from the texts themselves."""
    return fit(training_rows(sample_windows(documents, texts)))


# --- texts ------------------------------------------------------------------------------------

SPANS = "array<struct<kind:string,start:long,end:long>>"


def all_spans(text: str, tagger: Tagger) -> list[tuple[int, int, str]]:
    """Matches of the patterns and the tagged spans that touch none of them, in order."""
    base = base_spans(text)
    tagged = tagger.spans(text)
    ends = np.maximum.accumulate([end for _, end, _ in base]) if base else np.zeros(0)
    starts = np.array([start for start, _, _ in base])
    out = list(base)
    for start, end in tagged:
        before = int(np.searchsorted(starts, end, "left"))
        if not before or ends[before - 1] <= start:
            out.append((start, end, "crf"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def find(documents: DataFrame, model: SecretModel) -> DataFrame:
    """``documents`` with ``spans``: kind, start and end of every secret in the whole text."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e} for s, e, k in all_spans(text.as_py(), tagger)] for text in batch.column(last)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(found, kind)], names=[*names, "spans"])

    kept = documents.drop("spans")
    last, names = len(kept.columns), kept.columns
    schema = kept.withColumn("spans", F.lit(None).cast(SPANS)).schema
    return kept.withColumn("__text", text_column(documents, "text")).mapInArrow(run, schema)
