"""Toxicity scores by a recurrent network over words and their characters, trained in numpy."""

import functools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields
from itertools import chain, groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemill.llm.common import pick

#: A word is a run of letters, digits and underscores; long ones are cut.
WORD = re.compile(r"\w{1,12}")
#: Words of a window, and from one window to the next.
WINDOW, STEP = 32, 16
#: Words with a vector of their own, buckets of characters, and widths of the layers.
VOCABULARY, CHAR_BUCKETS = 1 << 14, 256
WORD_WIDTH, CHAR_WIDTH, CHAR_STATE, STATE, ATTENTION = 8, 8, 8, 12, 16
#: The bounded sample that the network learns from: documents of each label, with all their windows.
TOXIC_DOCUMENTS, CLEAN_DOCUMENTS = 1200, 2400
UPDATES, BATCH, RATE = 900, 66, 0.01
#: Small samples get fewer updates: so many times through their windows.
ROUNDS, FEWEST_UPDATES = 12, 200
#: Documents of the sample that a word, or a start of so many letters, must be in to count.
SHARED_BY = 3
STEMS = (3, 4, 5, 6)
#: How telling a word must be to be a hint, and to stay in toxic windows.
HINT, TELLING = 0.25, 0.15
#: Documents' worth of doubt whether a word in toxic ones only is so by chance.
DOUBT = 6
#: Telling words that are added to each batch, and half the number of clean documents' words.
HINTS = 100
#: Share of the other words that stay in toxic windows.
KEPT = 0.8
#: Share of words taken as unknown in training, and after which shares of the updates windows are
#: relabelled.
FORGOTTEN = 0.3
RELABELLED = (0.28, 0.44, 0.61, 0.78, 0.89)
#: Clean windows that are scored then; the highest twentieth of them come up more often.
MINED = 8000
#: Of each label, one in so many documents of the sample serves to calibrate the scores only.
APART = 4
#: How far the two labels count alike when scores are fitted to them: 0 not at all, 1 in full.
BALANCE = 0.5
#: Distinct words whose inputs a task remembers at most.
REMEMBERED = 120_000
#: Windows that are scored at once.
SCORED = 2048


# --- the network --------------------------------------------------------------------------


@dataclass
class Network:
    """Weights. Gates lie side by side: update, reset, candidate."""

    chars: np.ndarray  # characters' vectors
    char_in: np.ndarray  # two directions: vector to gates
    char_bias: np.ndarray
    char_state: np.ndarray
    words: np.ndarray  # words' vectors; the first is for unknown words
    word_in: np.ndarray
    word_bias: np.ndarray
    word_state: np.ndarray
    attention: np.ndarray
    attention_bias: np.ndarray
    attention_out: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    hint: np.ndarray  # only for training: a word's input to how telling it is
    hint_bias: np.ndarray
    vocabulary: dict[str, int]

    @classmethod
    def new(cls, vocabulary: list[str], seed: int = 7) -> "Network":
        random = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)

        zeros = lambda *shape: np.zeros(shape, np.float32)
        features = 2 * CHAR_STATE + WORD_WIDTH
        return cls(
            chars=normal(CHAR_BUCKETS, CHAR_WIDTH) * 8,
            char_in=normal(2, CHAR_WIDTH, 3 * CHAR_STATE),
            char_bias=zeros(2, 3 * CHAR_STATE),
            char_state=normal(2, CHAR_STATE, 3 * CHAR_STATE),
            words=normal(len(vocabulary) + 1, WORD_WIDTH) * 0,
            word_in=normal(2, features, 3 * STATE),
            word_bias=zeros(2, 3 * STATE),
            word_state=normal(2, STATE, 3 * STATE),
            attention=normal(2 * STATE, ATTENTION),
            attention_bias=zeros(ATTENTION),
            attention_out=normal(ATTENTION, 1)[:, 0],
            out=normal(2 * STATE, 1)[:, 0],
            out_bias=zeros(1),
            hint=normal(features, 1)[:, 0],
            hint_bias=zeros(1),
            vocabulary={word: k for k, word in enumerate(vocabulary, 1)},
        )

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.array([self.vocabulary.get(w, 0) for w in words], np.int64)


#: The fields that are learned.
LEARNED = tuple(f.name for f in fields(Network) if f.name != "vocabulary")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def gru(inputs: np.ndarray, state: np.ndarray, mask: np.ndarray | None, keep: bool):
    """States after each step of (step, row, gates) inputs; where the mask is 0 a state stays.

    With ``keep``, also what the way back needs.
    """
    steps, rows, gates = inputs.shape
    width = gates // 3
    states = np.zeros((steps + 1, rows, width), np.float32)
    kept = []
    for t in range(steps):
        before, x = states[t], inputs[t]
        inner = before @ state
        both = _sigmoid(x[:, : 2 * width] + inner[:, : 2 * width])
        update, reset = both[:, :width], both[:, width:]
        candidate = np.tanh(x[:, 2 * width :] + reset * inner[:, 2 * width :])
        after = candidate + update * (before - candidate)
        if mask is not None:
            after = before + mask[t][:, None] * (after - before)
        states[t + 1] = after
        if keep:
            kept.append((update, reset, candidate, inner[:, 2 * width :]))
    return states, kept


def gru_back(states, kept, state, mask, d_states):
    """Gradients of the inputs and of the state weights from those of the states after a step."""
    steps, rows, width = d_states.shape
    d_inputs = np.zeros((steps, rows, 3 * width), np.float32)
    d_weights = np.zeros_like(state)
    d_after = np.zeros((rows, width), np.float32)
    for t in range(steps - 1, -1, -1):
        update, reset, candidate, inner = kept[t]
        before = states[t]
        d_after = d_after + d_states[t]
        on = mask[t][:, None]
        d_new = d_after * on
        d_before = d_after * (1 - on) + d_new * update
        d_candidate = d_new * (1 - update) * (1 - candidate**2)
        d_update = d_new * (before - candidate) * update * (1 - update)
        d_reset = d_candidate * inner * reset * (1 - reset)
        d_inputs[t] = np.concatenate([d_update, d_reset, d_candidate], axis=1)
        d_inner = np.concatenate([d_update, d_reset, d_candidate * reset], axis=1)
        d_weights += before.T @ d_inner
        d_after = d_before + d_inner @ state.T
    return d_inputs, d_weights


def _both(inputs, state, mask, keep):
    """Two directions; each one's steps in its own order."""
    reverse = None if mask is None else mask[::-1]
    return gru(inputs[0], state[0], mask, keep), gru(inputs[1][::-1], state[1], reverse, keep)


def characters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(step, word) numbers of characters, and where there are any."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    longest = int(sizes.max(initial=1))
    mask = np.arange(longest)[:, None] < sizes
    numbers = np.zeros((longest, len(words)), np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    numbers.T[mask.T] = codes % CHAR_BUCKETS
    return numbers, mask.astype(np.float32)


def word_inputs(net: Network, words: list[str]) -> np.ndarray:
    """What the words' network gets from each word: both directions' gates, side by side."""
    out = np.zeros((len(words), 6 * STATE), np.float32)
    by_char = [net.chars @ net.char_in[d] + net.char_bias[d] for d in (0, 1)]
    by_length: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        by_length.setdefault(len(word), []).append(k)
    for places in by_length.values():
        some = [words[k] for k in places]
        numbers, _ = characters(some)
        inputs = [by_char[d][numbers] for d in (0, 1)]
        (there, _), (back, _) = _both(inputs, net.char_state, None, False)
        features = np.concatenate([there[-1], back[-1], net.words[net.numbers(some)]], axis=1)
        for d in (0, 1):
            out[places, d * 3 * STATE : (d + 1) * 3 * STATE] = (
                features @ net.word_in[d] + net.word_bias[d]
            )
    return out


def window_scores(net: Network, inputs: np.ndarray, places: np.ndarray, sizes: np.ndarray):
    """Of windows, given as places of words among the inputs; the logit of each."""
    steps = int(sizes.max())
    places = places[:, :steps].T
    mask = (np.arange(steps)[:, None] < sizes[None]).astype(np.float32)
    whole = None if mask.all() else mask
    gates = 3 * STATE
    given = [inputs[places, d * gates : (d + 1) * gates] for d in (0, 1)]
    (there, _), (back, _) = _both(given, net.word_state, whole, False)
    states = np.concatenate([there[1:], back[1:][::-1]], axis=2)
    _, _, pooled = _attend(net, states, mask)
    return pooled @ net.out + net.out_bias


def _attend(net, states, mask):
    hidden = np.tanh(states @ net.attention + net.attention_bias)
    scores = hidden @ net.attention_out
    scores = np.where(mask > 0, scores, -1e9)
    weights = np.exp(scores - scores.max(axis=0))
    weights /= weights.sum(axis=0)
    return hidden, weights, np.einsum("tb,tbh->bh", weights, states)


def gradients(net: Network, words: list[str], known, telling, places, sizes, labels):
    """Loss, and the gradient of each weight, over a batch of windows of the words.

    ``known`` has the words' numbers in the vocabulary, ``telling`` how much each says by itself;
    the words' inputs learn to foretell that as well.
    """
    steps = int(sizes.max())
    places = places[:, :steps].T
    mask = (np.arange(steps)[:, None] < sizes[None]).astype(np.float32)
    numbers, char_mask = characters(words)
    vectors = net.chars[numbers]
    by_char = [net.chars @ net.char_in[d] + net.char_bias[d] for d in (0, 1)]
    char_inputs = [by_char[d][numbers] for d in (0, 1)]
    char_way = _both(char_inputs, net.char_state, char_mask, True)
    features = np.concatenate(
        [char_way[0][0][-1], char_way[1][0][-1], net.words[known]], axis=1
    )
    inputs = [features @ net.word_in[d] + net.word_bias[d] for d in (0, 1)]
    way = _both([x[places] for x in inputs], net.word_state, mask, True)
    states = np.concatenate([way[0][0][1:], way[1][0][1:][::-1]], axis=2)
    hidden, weights, pooled = _attend(net, states, mask)
    score = _sigmoid(pooled @ net.out + net.out_bias)
    loss = -np.mean(np.log(np.where(labels > 0, score, 1 - score) + 1e-9))

    # the way back
    d = {name: np.zeros_like(getattr(net, name)) for name in LEARNED}
    d_logit = ((score - labels) / len(labels)).astype(np.float32)
    d["out"] = pooled.T @ d_logit
    d["out_bias"] = d_logit.sum(keepdims=True)
    d_pooled = d_logit[:, None] * net.out
    d_states = weights[:, :, None] * d_pooled
    d_weights = np.einsum("bh,tbh->tb", d_pooled, states)
    d_scores = weights * (d_weights - (weights * d_weights).sum(axis=0))
    d["attention_out"] = d_scores.ravel() @ hidden.reshape(-1, ATTENTION)
    d_hidden = d_scores[:, :, None] * net.attention_out * (1 - hidden**2)
    d["attention"] = _flat(states).T @ _flat(d_hidden)
    d["attention_bias"] = d_hidden.sum(axis=(0, 1))
    d_states = d_states + (_flat(d_hidden) @ net.attention.T).reshape(d_states.shape)
    hinted = _sigmoid(features @ net.hint + net.hint_bias)
    weight = np.where(telling > 0.5, 1.0, 0.3)
    told = telling * np.log(hinted + 1e-9) + (1 - telling) * np.log(1 - hinted + 1e-9)
    loss -= (told * weight).sum() / weight.sum()
    d_hint = ((hinted - telling) * weight / weight.sum()).astype(np.float32)
    d["hint"] = features.T @ d_hint
    d["hint_bias"] = d_hint.sum(keepdims=True)
    d_features = d_hint[:, None] * net.hint
    for k in (0, 1):
        part = d_states[:, :, k * STATE : (k + 1) * STATE]
        turned, turned_mask = (part, mask) if k == 0 else (part[::-1], mask[::-1])
        d_in, d["word_state"][k] = gru_back(
            way[k][0], way[k][1], net.word_state[k], turned_mask, turned
        )
        d_in = d_in if k == 0 else d_in[::-1]
        d_words = np.zeros_like(inputs[k])
        np.add.at(d_words, places.ravel(), d_in.reshape(-1, 3 * STATE))
        d["word_in"][k] = features.T @ d_words
        d["word_bias"][k] = d_words.sum(axis=0)
        d_features += d_words @ net.word_in[k].T
    np.add.at(d["words"], known, d_features[:, 2 * CHAR_STATE :])
    for k in (0, 1):
        ends = np.zeros((len(numbers), len(words), CHAR_STATE), np.float32)
        ends[-1] = d_features[:, k * CHAR_STATE : (k + 1) * CHAR_STATE]
        turned_mask = char_mask if k == 0 else char_mask[::-1]
        d_in, d["char_state"][k] = gru_back(
            char_way[k][0], char_way[k][1], net.char_state[k], turned_mask, ends
        )
        d_in = d_in if k == 0 else d_in[::-1]
        d["char_in"][k] = _flat(vectors).T @ _flat(d_in)
        d["char_bias"][k] = d_in.sum(axis=(0, 1))
        np.add.at(d["chars"], numbers.ravel(), _flat(d_in) @ net.char_in[k].T)
    return loss, d


def _flat(x: np.ndarray) -> np.ndarray:
    return x.reshape(-1, x.shape[-1])


# --- windows and training -----------------------------------------------------------------


def window_starts(n_words: int) -> np.ndarray:
    """Where a text's windows start: every STEP words, and so that the last ends with the text."""
    if n_words <= WINDOW:
        return np.zeros(min(n_words, 1), np.int64)
    return np.unique(np.r_[np.arange(0, n_words - WINDOW, STEP), n_words - WINDOW])


def _places(listed: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, and the windows as places among them."""
    number: dict[str, int] = {}
    places = np.zeros((len(listed), WINDOW), np.int64)
    for k, words in enumerate(listed):
        places[k, : len(words)] = [number.setdefault(w, len(number)) for w in words]
    return list(number), places, np.array([len(words) for words in listed])


def _stems(word: str) -> list[str]:
    """How a word begins, marked as such."""
    return ["^" + word[:n] for n in STEMS if len(word) >= n]


def train(windows: list[tuple[int, int, list[str]]], seed: int = 7) -> Network | None:
    """A network from (document, label, words) windows; None unless there are both labels.

    A label is of a whole document, and few of a toxic one's windows are toxic. Those count as toxic
    that have a word, or a start of a word, which tells toxic documents from clean ones; if a document
    has none, all its windows do at first. Later those that score above a half, or highest within their
    document, are added; others take no part.

    Words that clean documents have as well say nothing about toxicity by themselves, but a network
    could learn a window by heart from them; in toxic windows words of clean ones stand in for some
    of them, new ones each time. Beside the labels, the words' inputs are trained to
    foretell which words toxic documents have to themselves. Some words are taken as unknown, so
    that the characters have to do. Last, the logits are scaled and shifted so that those of the
    highest windows of documents kept apart come out as probabilities, the rarer label counting more.
    """
    labels = np.array([label for _, label, _ in windows], np.float32)
    if not 0 < labels.sum() < len(labels):
        return None
    windows, apart = _parted(windows, seed)
    labels = np.array([label for _, label, _ in windows], np.float32)
    random = np.random.default_rng(seed)
    n_in, n_toxic = Counter(), Counter()
    for _, label, words in _by_document(windows):
        both = words | {stem for word in words for stem in _stems(word)}
        n_in.update(both)
        if label:
            n_toxic.update(both)
    listed = [w for w, n in n_in.most_common() if n >= SHARED_BY and w[0] != "^"]
    net = Network.new(sorted(listed[:VOCABULARY]), seed)
    document_labels = [label for _, label, _ in _by_document(windows)]
    usual = sum(document_labels) / len(document_labels)

    def telling(word: str) -> float:
        """How far a word, or how it begins, is from being as usual in clean documents: 0 to 1."""
        most = 0.0
        for key in (word, *_stems(word)):
            if n_in[key] >= SHARED_BY:
                share = (n_toxic[key] + DOUBT * usual) / (n_in[key] + DOUBT)
                most = max(most, (share - usual) / (1 - usual))
        return most

    telling = functools.cache(telling)
    evidence = sorted(w for w in n_toxic if w[0] != "^" and telling(w) > HINT)
    others = np.array([word for _, label, words in windows if not label for word in words])
    told = np.array([l > 0 and any(telling(w) > HINT for w in ws) for _, l, ws in windows])
    plain = {document for document, _, _ in windows}
    plain -= {windows[k][0] for k in np.flatnonzero(told)}
    labels[[l > 0 and not t and d not in plain for (d, l, _), t in zip(windows, told, strict=True)]] = -1

    def words_of(k: int) -> list[str]:
        words = windows[k][2]
        if labels[k]:
            swaps = random.choice(others, len(words)).tolist()
            keep = random.random(len(words)) < KEPT
            words = [
                w if k or telling(w) > TELLING else s for w, s, k in zip(words, swaps, keep, strict=True)
            ]
        return words

    clean = hard = np.flatnonzero(labels == 0)
    first = {name: np.zeros_like(getattr(net, name)) for name in LEARNED}
    second = {name: np.zeros_like(getattr(net, name)) for name in LEARNED}
    updates = int(np.clip(ROUNDS * len(windows) / BATCH, FEWEST_UPDATES, UPDATES))
    relabelled = {int(share * updates) for share in RELABELLED}
    for update in range(1, updates + 1):
        if update in relabelled:
            labels = _relabelled(net, windows, labels, told)
            some = random.choice(clean, min(len(clean), MINED), replace=False)
            hard = some[np.argsort(-_scores(net, windows, some))[: max(len(some) // 20, 1)]]
        toxic = np.flatnonzero(labels == 1)
        third = BATCH // 3
        chosen = np.r_[
            random.choice(toxic, third), random.choice(hard, third), random.choice(clean, third)
        ]
        words, places, sizes = _places([words_of(k) for k in chosen])
        if evidence:
            words += random.choice(evidence, HINTS).tolist()
        words += random.choice(others, 2 * HINTS).tolist()
        known = net.numbers(words)
        known[random.random(len(known)) < FORGOTTEN] = 0
        said = np.array([telling(w) for w in words], np.float32)
        _, d = gradients(net, words, known, said, places, sizes, labels[chosen])
        rate = RATE * (1 - update / (updates + 1)) ** 0.5
        for name in LEARNED:  # Adam
            g = d[name]
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.99 * second[name] + 0.01 * g * g
            step = first[name] / (1 - 0.9**update)
            scale = np.sqrt(second[name] / (1 - 0.99**update)) + 1e-6
            setattr(net, name, (getattr(net, name) - rate * step / scale).astype(np.float32))
    return _calibrated(net, apart)


def _parted(windows, seed: int) -> tuple[list, list]:
    """Windows to learn from, and those of every APART-th document of each label, for the calibration:
    on documents that the network has learned from it would be too sure. One document of a label is
    for both."""
    documents: dict[int, list[int]] = {0: [], 1: []}
    for document, label, _ in _by_document(windows):
        documents[label].append(document)
    learned, apart = set(), set()
    for some in documents.values():
        some = np.random.default_rng(seed).permutation(some).tolist()
        apart.update(some[::APART])
        learned.update(some if len(some) == 1 else [d for k, d in enumerate(some) if k % APART])
    return [w for w in windows if w[0] in learned], [w for w in windows if w[0] in apart]


def _calibrated(net: Network, windows) -> Network:
    """Logistic regression of the documents' labels on their highest windows, by Newton steps."""
    scores = _scores(net, windows, np.arange(len(windows)))
    highest: dict[int, float] = {}
    label: dict[int, int] = {}
    for (document, value, _), score in zip(windows, scores.tolist(), strict=True):
        highest[document] = max(score, highest.get(document, -np.inf))
        label[document] = value
    x = np.array([[highest[k], 1.0] for k in highest])
    y = np.array([label[k] for k in highest], float)
    share = y.mean()
    counted = np.where(y == 1, (1 - share) / share, 1.0) ** BALANCE
    weights = np.array([1.0, 0.0])
    for _ in range(25):
        p = _sigmoid(x @ weights)
        hessian = (x * (counted * p * (1 - p))[:, None]).T @ x + np.diag([0.1, 0.01])
        step = np.linalg.solve(hessian, x.T @ (counted * (p - y)) + [0.1 * (weights[0] - 1), 0.0])
        weights -= np.clip(step, -1, 1)
    net.out = (net.out * weights[0]).astype(np.float32)
    net.out_bias = (net.out_bias * weights[0] + weights[1]).astype(np.float32)
    return net


def _by_document(windows) -> Iterator[tuple[int, int, set[str]]]:
    """The distinct words of each document's windows, which lie together."""
    for (document, label), some in groupby(windows, key=lambda w: (w[0], w[1])):
        yield document, label, {word for _, _, words in some for word in words}


def _scores(net: Network, windows, chosen: np.ndarray) -> np.ndarray:
    words, places, sizes = _places([windows[k][2] for k in chosen])
    inputs = word_inputs(net, words)
    return np.concatenate(
        [
            window_scores(net, inputs, places[k : k + SCORED], sizes[k : k + SCORED])
            for k in range(0, len(chosen), SCORED)
        ]
    )


def _relabelled(net: Network, windows, labels: np.ndarray, told: np.ndarray) -> np.ndarray:
    """Of each toxic document, windows with a telling word, those that score above a half, and the
    highest are toxic (1); the others take no part (-1)."""
    toxic = np.array([k for k, (_, label, _) in enumerate(windows) if label])
    scores = _scores(net, windows, toxic)
    best: dict[int, tuple[float, int]] = {}
    for at, score in zip(toxic.tolist(), scores.tolist(), strict=True):
        document = windows[at][0]
        if document not in best or score > best[document][0]:
            best[document] = score, at
    labels = labels.copy()
    labels[toxic] = np.where((scores > 0) | told[toxic], 1, -1)
    labels[[at for _, at in best.values()]] = 1
    return labels


class Scorer:
    """Scores texts by their highest window; remembers what the network gets from a word."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.inputs = np.zeros((REMEMBERED, 6 * STATE), np.float32)
        self.known: dict[str, int] = {}

    def _learn(self, words: set[str]) -> np.ndarray:
        if len(self.known) + len(words) > REMEMBERED:
            self.known = {}
            if len(words) > len(self.inputs):
                self.inputs = np.zeros((len(words), 6 * STATE), np.float32)
        new = list(words.difference(self.known))
        for k in range(0, len(new), 20_000):
            some = new[k : k + 20_000]
            at = len(self.known)
            self.inputs[at : at + len(some)] = word_inputs(self.net, some)
            self.known.update(zip(some, range(at, at + len(some)), strict=True))
        return self.inputs

    def scores(self, texts: list[str | None]) -> np.ndarray:
        listed = [WORD.findall(t.lower()) if isinstance(t, str) else [] for t in texts]
        words = set().union(*listed)
        if len(words) > REMEMBERED and len(texts) > 1:
            half = len(texts) // 2
            return np.concatenate([self.scores(texts[:half]), self.scores(texts[half:])])
        inputs = self._learn(words)
        number = self.known.__getitem__
        starts = [window_starts(len(words)) for words in listed]
        best = np.full(len(texts), -np.inf)
        if sum(map(len, listed)) == 0:
            return np.zeros(len(texts))
        flat = np.array(list(map(number, chain.from_iterable(listed))), np.int64)
        firsts = np.cumsum([0] + [len(words) for words in listed])[:-1]
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        at = np.concatenate(starts) + firsts[owner]
        sizes = np.minimum([len(words) for words in listed], WINDOW)[owner]
        order = np.argsort(-sizes, kind="stable")  # whole windows need no mask
        for k in range(0, len(order), SCORED):
            some = order[k : k + SCORED]
            columns = np.minimum(at[some, None] + np.arange(WINDOW), len(flat) - 1)
            logits = window_scores(self.net, inputs, flat[columns], sizes[some])
            np.maximum.at(best, owner[some], logits)
        return np.where(np.isneginf(best), 0.0, _sigmoid(best))


# --- operator -----------------------------------------------------------------------------


def sampled_windows(
    rows: DataFrame, labels: DataFrame, toxic: int, clean: int
) -> list[tuple[int, int, list[str]]]:
    """All windows of a bounded sample of labelled documents: those with the smallest hashes."""
    labels = labels.dropna().filter("label IN (0, 1)").distinct()
    chosen = {}
    for label, n in ((1, toxic), (0, clean)):
        some = labels.filter(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(n)
        chosen |= {row["id"]: label for row in some.collect()}

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [WORD.findall(t.lower()) if isinstance(t, str) else [] for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "words": [" ".join(words) for words in texts]})

    of = rows.filter(F.col("id").isin(list(chosen))).select("id", "text")
    found = of.mapInPandas(cut, "id bigint, words string").distinct().collect()
    windows, same = [], {}
    for row in sorted(found):
        words = [same.setdefault(word, word) for word in row["words"].split()]  # one object each
        windows += [
            (row["id"], chosen[row["id"]], words[k : k + WINDOW])
            for k in window_starts(len(words)).tolist()
        ]
    return windows


def scored(
    df: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    label_id_column: str = "doc_id",
    toxic_documents: int = TOXIC_DOCUMENTS,
    clean_documents: int = CLEAN_DOCUMENTS,
) -> DataFrame:
    """(id, score) of each row: the highest of its windows' probabilities of being toxic.

    The network is fitted on all windows of at most so many labelled documents of each kind, and then
    reads every window of every text: 32 words, half of them shared with the next. A word's input is
    a vector (of frequent words) and the end states of a two-way gated recurrent network over its
    characters; the words' states, from a second such network, are pooled by attention. Distinct words go
    through the characters' network once a task.

    NULL texts and texts without a word score 0. Labels other than 0 and 1 are left out; without
    labels of both kinds all scores are 0. Rows that repeat score alike. An empty table gives an
    empty one. Ids must be integers.
    """
    spark = df.sparkSession
    rows = pick(df, id=id_column, text=text_column)
    known = pick(labels, id=label_id_column, label=label_column)
    net = train(sampled_windows(rows, known, toxic_documents, clean_documents))
    if net is None:
        return rows.select("id", F.lit(0.0).alias("score"))
    weights = spark.sparkContext.broadcast({f.name: getattr(net, f.name) for f in fields(net)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(Network(**weights.value))
        for batch in batches:
            for k in range(0, len(batch), 250):
                some = batch.iloc[k : k + 250]
                yield pd.DataFrame(
                    {"id": some["id"], "score": scorer.scores(some["text"].tolist())}
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(run, f"id {kind}, score double")
