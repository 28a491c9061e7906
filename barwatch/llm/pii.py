"""Operator 10, personal data: fixed patterns and a skip-chain conditional random field.

Four patterns give the base spans. On top, a skip-chain CRF labels the tokens
that hold a digit or an "@" or equal the mailbox name of one that does (all
others are outside by construction and cut the chain): node potentials from the
token's shape, chain potentials between neighbouring tokens, and skip potentials
between the tokens of a document that repeat each other or share a core (the
same digits, the same mailbox name) and a hub that stands for them all. A hub
has the kinds that the patterns give its tokens, and is free where they give
none. Loopy sum-product message passing runs over all documents of a batch at
once, each until its messages settle; a token far from any pattern can so take
the label of the occurrence that a pattern confirms. Tokens whose marginal for a kind reaches ``ADD_FROM`` become
added spans, never across a base span.

Every token has at most one link to a hub, so their number is linear in the
tokens, whatever repeats, and any two of a hub's tokens are two hops apart.

Training needs no labels from outside: the base spans of a bounded sample (the
first ``SAMPLE`` documents by a hash of the id) are the labels, and the weights
maximise the pseudo-likelihood. Tokens with a chain or skip link are shown a
second time with most of their shape hidden, so that these weights learn to
speak for a token that is not clear by itself.

Defined results: NULL counts as empty: no spans. Positions are code points, ends
exclusive. Without training material only the base spans come out. Rows are
independent, so repeated rows get equal spans; a row whose messages do not settle
says so (``settled``); an empty table gives an empty
table. Long texts are searched whole, in linear time. Result columns replace
input columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import arrow_batch_rows, held, held_type, unheld
from barwatch.llm.textnum import pieces

# Kinds in order, and their patterns (see base_spans).
KINDS = ["email", "ip", "card", "phone"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SAMPLE = 6000
ADD_FROM = 0.9
SETTLED, DAMPING = 1e-6, 0.5      # messages that change less have settled
MOST_ROUNDS = 2000               # for a document whose messages never settle
GRAPH_CHARS = 1_000_000
NEVER = -30.0                    # log potential of a kind that a confirmed hub does not have
SKIP_PRIOR = 3.5                 # skip weights are pulled towards this for equal labels
TRAIN_ROUNDS, RIDGE, STEP = 300, 1e-3, 0.1

_MARK = re.compile(r"[0-9@]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_EDGE = ".,;:!?()[]{}<>\"'*#$%&|-"

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # Every match has its local part right before an "@": the run of local
    # characters there, as far back as the match before.
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = at = m.end()
        else:
            at += 1


def base_spans(text: str) -> list[Span]:
    """Spans of the four patterns: per kind leftmost and non-overlapping, matches
    that fail their check dropped; ordered by start, then kind."""
    out: list[tuple[int, int, int]] = []
    if "@" in text:
        out += [(s, 0, e) for s, e in _emails(text)]
    if _MARK.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            d = _digits(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted(out)]


def span_string(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


@dataclass
class Graph:
    """Tokens of a batch of documents, as nodes of one graph."""
    owner: list[int]
    start: list[int]
    end: list[int]
    shape: list[list[int]]       # feature numbers of each node
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]  # (node, hub)
    hubs: int = 0


SHAPES = ["bias", "at", "at_dot", "letters", "plus", "parens", "dash", "dots3", "parts_ok", "digits_only", "luhn", "edge",
          "hex", *[f"digits_{b}" for b in ("0", "1_3", "4_6", "7_9", "10_13", "14_19", "20")],
          *[f"before_{s}" for s in ("mark", "plus")], *[f"after_{s}" for s in ("mark", "parens")]]
_F = {s: i for i, s in enumerate(SHAPES)}
COARSE = [_F["bias"], _F["letters"]]     # what a masked token still shows


def _digit_class(n: int) -> str:
    for top, name in ((0, "0"), (3, "1_3"), (6, "4_6"), (9, "7_9"), (13, "10_13"), (19, "14_19")):
        if n <= top:
            return "digits_" + name
    return "digits_20"


def _shape(core: str) -> list[int]:
    d = _digits(core)
    names = ["bias", _digit_class(len(d))]
    if "@" in core:
        names.append("at")
        if "." in core.rpartition("@")[2]:
            names.append("at_dot")
    if any(c.isalpha() for c in core):
        names.append("letters")
        if d and len(core) >= 16 and all(c in "0123456789abcdefABCDEF" for c in core):
            names.append("hex")
    if core.startswith("+"):
        names.append("plus")
    if "(" in core or ")" in core:
        names.append("parens")
    if "-" in core:
        names.append("dash")
    parts = core.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        names.append("dots3")
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            names.append("parts_ok")
    if core == d:
        names.append("digits_only")
    if 14 <= len(d) <= 19 and luhn(d):
        names.append("luhn")
    return [_F[n] for n in names]


def _cores(core: str) -> list[str]:
    """Keys under which a token repeats or resembles another one."""
    low, d = core.lower(), _digits(core)
    keys = ["=" + low] if len(low) >= 4 else []
    if len(d) >= 7:
        keys.append("#" + d)
    name = low.partition("@")[0]
    if len(name) >= 5 and not name.isdigit():
        keys.append("@" + name)
    return keys


def _marked(text: str) -> list[tuple[int, int, bool]]:
    """(begin, stop, holds a mark) of the tokens that become nodes."""
    out, names, done = [], set(), 0
    for m in _MARK.finditer(text):
        if m.start() < done:
            continue
        begin = max(done, max(text.rfind(c, done, m.start()) for c in " \t\n\x0b\x0c\r") + 1)
        stop = _BLANK.search(text, m.end())
        done = stop.start() if stop else len(text)
        out.append((begin, done, True))
        core = text[begin:done].strip(_EDGE).lower()
        if "@" in core:
            names.update(k[1:] for k in _cores(core) if k[0] == "@")
    if names:
        out += [(m.start(), m.end(), False) for m in _WORD.finditer(text)
                if m[0].strip(_EDGE).lower() in names and not _MARK.search(m[0])]
    return sorted(out)


def build_graph(texts: list[str]) -> Graph:
    g = Graph([], [], [], [], [], [])
    for i, text in enumerate(texts):
        first, up = {}, {}                                  # first node of a key; a node's parent in its class
        done, before = 0, -2

        def root(n: int) -> int:
            while up[n] != n:
                up[n] = n = up[up[n]]
            return n

        for begin, stop, mark in _marked(text):
            raw = text[begin:stop]
            core = raw.strip(_EDGE)
            node = len(g.owner)
            # "(988)" keeps its parentheses as shape; the core is what can become a span.
            shape = _shape(core) + ([_F["parens"]] if "(" in raw or ")" in raw else []) + ([_F["edge"]] if raw != core else [])
            lead = len(raw) - len(raw.lstrip(_EDGE))
            neighbour = mark and begin - done <= 1 and before == node - 1 and node and g.owner[-1] == i
            g.owner.append(i)
            g.start.append(begin + lead)
            g.end.append(begin + lead + len(core))
            if neighbour:
                g.chain.append((node - 1, node))
                shape.append(_F["before_mark"])
                if _F["plus"] in g.shape[node - 1]:
                    shape.append(_F["before_plus"])
                g.shape[node - 1].append(_F["after_mark"])
                if _F["parens"] in shape:
                    g.shape[node - 1].append(_F["after_parens"])
            g.shape.append(shape)
            up[node] = node
            for key in _cores(core):
                up[root(node)] = root(first.setdefault(key, node))
            if mark:
                done, before = stop, node
        classes: dict[int, list[int]] = {}
        for n in up:
            classes.setdefault(root(n), []).append(n)
        for members in classes.values():
            if len(members) > 1:
                g.skip += [(n, g.hubs) for n in members]
                g.hubs += 1
    return g


def _hub_kinds(g: Graph, label: np.ndarray, labels: int) -> np.ndarray:
    """How many nodes of each hub the patterns give each label; outside is not counted."""
    out = np.zeros((g.hubs, labels))
    for n, h in g.skip:
        if label[n]:
            out[h, label[n]] += 1
    return out


@dataclass
class SkipChainCRF:
    node: np.ndarray             # (shapes, labels); label 0 is outside
    chain: np.ndarray            # (labels, labels), left to right
    skip: np.ndarray             # (labels, labels), symmetric

    def potentials(self, g: Graph) -> np.ndarray:
        flat = np.array([f for s in g.shape for f in s], np.int64)
        row = np.repeat(np.arange(len(g.shape)), [len(s) for s in g.shape])
        out = np.zeros((len(g.shape), self.node.shape[1]))
        np.add.at(out, row, self.node[flat])
        return out

    def marginals(self, g: Graph, label: np.ndarray | None = None) -> np.ndarray:
        return self.settle(g, label)[0]

    def settle(self, g: Graph, label: np.ndarray | None = None) -> tuple[np.ndarray, set[int]]:
        """(marginals, documents whose messages were still moving at the end). Loopy
        sum-product, all documents at once; log messages, damped. ``label``: what
        the patterns give each node, 0 where they give nothing."""
        unary = self.potentials(g)
        if not g.chain and not g.skip:
            return _softmax(unary), set()
        nodes, labels = unary.shape
        kinds = _hub_kinds(g, np.zeros(nodes, np.int64) if label is None else label, labels)
        free = ~kinds.any(axis=1)
        share = kinds / np.maximum(kinds.sum(axis=1, keepdims=True), 1)
        hub = np.where(free[:, None], 0.0, np.log(np.maximum(share, np.exp(NEVER))))
        unary = np.concatenate([unary, hub])
        a, b = np.array([*g.chain, *[(n, nodes + h) for n, h in g.skip]], np.int64).T
        kind = np.array([*[0] * len(g.chain), *[1 + int(free[h]) for _, h in g.skip]], np.int64)
        pair = np.stack([self.chain, self.skip, _half(self.skip)])[kind]
        src, dst = np.concatenate([a, b]), np.concatenate([b, a])
        pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        doc = np.tile(np.array(g.owner)[a], 2)
        msg = np.zeros((len(src), labels))
        at = np.arange(len(src))                            # messages of documents that have not settled
        for _ in range(MOST_ROUNDS):
            belief = unary.copy()
            np.add.at(belief, dst[at], msg[at])
            out = (belief[src[at]] - msg[back[at]])[:, :, None] + pair[at]
            top = out.max(axis=1, keepdims=True)
            new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
            new -= new.max(axis=1, keepdims=True)
            moves = np.zeros(doc.max() + 1, bool)
            moves[doc[at[np.abs(new - msg[at]).max(axis=1) > SETTLED]]] = True
            msg[at] = DAMPING * msg[at] + (1 - DAMPING) * new
            at = at[moves[doc[at]]]
            if not len(at):
                break
        belief = unary.copy()
        np.add.at(belief, dst, msg)
        return _softmax(belief[:nodes]), set(doc[at].tolist())


def _half(pair: np.ndarray) -> np.ndarray:
    """Potentials that over two hops make ``pair``: two tokens of a free hub are as close as with a link of their own."""
    value, vector = np.linalg.eigh(np.exp(pair - pair.max()))
    return np.log(np.maximum((vector * np.sqrt(np.maximum(value, 0.0))) @ vector.T, 1e-12))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True)) if len(x) else x
    return e / e.sum(axis=1, keepdims=True) if len(x) else x


def _gold(g: Graph, spans: list[list[Span]]) -> np.ndarray:
    label = np.zeros(len(g.owner), np.int64)
    at, doc = 0, -1
    for n, (i, s, e) in enumerate(zip(g.owner, g.start, g.end)):
        if i != doc:
            doc, at = i, 0
        own = spans[i]
        while at < len(own) and own[at][2] <= s:
            at += 1
        if at < len(own) and own[at][1] < e:
            label[n] = 1 + KINDS.index(own[at][0])
    return label


def fit_crf(texts: list[str]) -> SkipChainCRF:
    """Pseudo-likelihood fit; the labels are the texts' base spans."""
    labels = len(KINDS) + 1
    g = build_graph(texts)
    y = _gold(g, [base_spans(t) for t in texts])
    n = len(y)
    prior = SKIP_PRIOR * np.eye(labels)
    if not n:
        none = np.zeros((len(SHAPES), labels))
        none[_F["bias"], 0] = 5.0
        return SkipChainCRF(none, np.zeros((labels, labels)), prior)
    linked = np.zeros(n, bool)                              # a token that has a word from others is also shown masked
    for a, b in g.chain:
        linked[a] = linked[b] = True
    for a, _ in g.skip:
        linked[a] = True
    shown = [*g.shape, *[COARSE[:1] + [f for f in COARSE[1:] if f in s] for s, h in zip(g.shape, linked) if h]]
    node_of = np.concatenate([np.arange(n), np.flatnonzero(linked)])
    x = np.zeros((len(shown), len(SHAPES)))
    for r, s in enumerate(shown):
        x[r, s] = 1
    one = np.eye(labels)[y]
    left, right, near = np.zeros((n, labels)), np.zeros((n, labels)), np.zeros((n, labels))
    for a, b in g.chain:
        left[b] += one[a]
        right[a] += one[b]
    kinds = _hub_kinds(g, y, labels)
    for a, h in g.skip:
        others = kinds[h] - (one[a] if y[a] else 0)         # a hub's kinds without the node's own
        near[a] = others / others.sum() if others.any() else np.eye(labels)[0]
    left, right, near, target = left[node_of], right[node_of], near[node_of], one[node_of]
    theta = [np.zeros((len(SHAPES), labels)), np.zeros((labels, labels)), prior.copy()]
    m, v = [0.0 * t for t in theta], [0.0 * t for t in theta]
    for t in range(1, TRAIN_ROUNDS + 1):
        w, c, s = theta
        error = (_softmax(x @ w + left @ c + right @ c.T + near @ s) - target) / len(target)
        skip = near.T @ error
        grads = [x.T @ error + RIDGE * w, left.T @ error + (right.T @ error).T + RIDGE * c,
                 (skip + skip.T) / 2 + RIDGE * (s - prior)]
        for k, grad in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.999 * v[k] + 0.001 * grad * grad
            theta[k] = theta[k] - STEP * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return SkipChainCRF(*theta)


def all_spans(crf: SkipChainCRF, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    return [found[:2] for found in find_spans(crf, texts)]


def find_spans(crf: SkipChainCRF, texts: list[str]) -> list[tuple[list[Span], list[Span], bool]]:
    """(base spans, all spans, whether the messages settled) of each text; a graph
    holds texts of ``GRAPH_CHARS`` characters together, or one longer text."""
    return [found for lo, hi in pieces(texts, GRAPH_CHARS) for found in _find_spans(crf, texts[lo:hi])]


def _find_spans(crf: SkipChainCRF, texts: list[str]) -> list[tuple[list[Span], list[Span], bool]]:
    base = [base_spans(t) for t in texts]
    g = build_graph(texts)
    if not g.owner:
        return [(b, b, True) for b in base]
    gold = _gold(g, base)
    p, moving = crf.settle(g, gold)
    label = p.argmax(axis=1)
    sure = (label > 0) & (p[np.arange(len(p)), label] >= ADD_FROM) & (gold == 0)
    added: dict[int, list[Span]] = {}
    chained = {b for _, b in g.chain}
    for n in np.flatnonzero(sure).tolist():
        if g.end[n] <= g.start[n]:
            continue
        own, kind = added.setdefault(g.owner[n], []), KINDS[label[n] - 1]
        joins = own and n in chained and sure[n - 1] and own[-1][0] == kind and own[-1][2] == g.end[n - 1]
        # Parts of one number join; two whole numbers side by side stay two spans.
        if joins and len(_digits(texts[g.owner[n]][own[-1][1]:g.end[n]])) <= 19:
            own[-1] = (kind, own[-1][1], g.end[n])
        else:
            own.append((kind, g.start[n], g.end[n]))
    order = lambda s: (s[1], KINDS.index(s[0]))
    return [(b, sorted(b + added[i], key=order) if i in added else b, i not in moving) for i, b in enumerate(base)]


def learn_pii(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> SkipChainCRF:
    """Fit on the base spans of the sample."""
    arrow_batch_rows(docs.sparkSession, 256)
    ids = docs.select(F.col(f"`{id_col}`").alias("_id")).filter("_id IS NOT NULL").distinct() \
              .orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE)
    rows = F.broadcast(ids).join(docs.select(F.col(f"`{id_col}`").alias("_k"), F.col(f"`{text}`").alias("t")),
                                 F.col("_id") == F.col("_k")).filter("t RLIKE '[0-9@]'")
    # An id may have any number of rows: one stands for them, so the sample is bounded by rows.
    sample = rows.groupBy("_id").agg(F.min_by("t", F.xxhash64("t")).alias("t")).select("t")

    def near_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only the tokens with a mark matter, so only they and their gaps go to the fit.
        for b in batches:
            out = []
            for t in b.column(0).to_pylist():
                g, base = build_graph([t]), base_spans(t)
                bounds = sorted([(s, e) for s, e in zip(g.start, g.end)] + [(s, e) for _, s, e in base])
                parts, at = [], 0
                for s, e in bounds:
                    if e > at:
                        parts.append(("" if s <= at + 1 and at else " x ") + t[max(s - 1, at):min(e + 1, len(t))])
                        at = min(e + 1, len(t))
                out.append("".join(parts))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["t"])

    return fit_crf(sorted(sample.mapInArrow(near_marks, "t string").toPandas()["t"]))


def find_pii(docs: DataFrame, crf: SkipChainCRF, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) with n_email, n_ip, n_card, n_phone (base
    spans), base_spans and pii_spans as arrays of (kind, start, end), and
    ``redacted``: the text with every span replaced by its kind in brackets
    (overlapping spans as one, named by the first), and ``settled``: false if the
    messages still moved after ``MOST_ROUNDS`` rounds, whose beliefs then count."""
    arrow_batch_rows(docs.sparkSession, 256)
    counts = [f"n_{k}" for k in KINDS]
    new = [*counts, "base_spans", "pii_spans", "redacted", "settled"]
    cols = [c for c in (keep if keep is not None else docs.columns) if c.lower() not in new]
    src = docs.select(held(cols), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    rows = lambda spans: [[{"kind": k, "start": s, "end": e} for k, s, e in own] for own in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            found = find_spans(crf, texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0),
                 *[pa.array([sum(s[0] == k for s in base) for base, _, _ in found], pa.int64()) for k in KINDS],
                 pa.array(rows(base for base, _, _ in found), span), pa.array(rows(every for _, every, _ in found), span),
                 pa.array([redact(t, every) for t, (_, every, _) in zip(texts, found)], pa.string()),
                 pa.array([settled for _, _, settled in found], pa.bool_())],
                names=["held", *new])

    kind = "array<struct<kind: string, start: bigint, end: bigint>>"
    return src.mapInArrow(run, f"{held_type(src)}, " + ", ".join(f"{c} bigint" for c in counts)
                          + f", base_spans {kind}, pii_spans {kind}, redacted string, settled boolean").select(*unheld(cols), *new)


def redact(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for kind, s, e in spans:
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])

