"""Skip-chain conditional random field over token labels, in numpy.

Chain part: every token type contributes a score vector at each window offset, plus a few
positional features, plus label transitions; it is fitted by maximum likelihood.  Skip
part: distant tokens of one document with the same or a similar form share a potential
over their two labels; inference passes messages along these links and along
the chain in turn (loopy belief propagation) until the rounds are over.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Value of a positional feature; above 1 it is learnt before the many features of rare tokens.
POSITION_VALUE = 3.0
#: Tokens of a block and of its context on either side; steps between rescalings.
BLOCK, CONTEXT, RESCALE = 160, 48, 6
OFFSETS = (-3, -2, -1, 0, 1, 2, 3)


class SkipChainCRF:
    def __init__(self, labels: list[str], type_features: Callable[[str], list[str]]):
        self.labels, self.features = labels, type_features
        self.index: dict[tuple[int, str], int] = {}
        self.weights = np.zeros((0, len(labels)))
        self.position_index: dict[str, int] = {}
        self.position_weights = np.zeros((0, len(labels)))
        self.trans = np.zeros((len(labels), len(labels)))
        self.start = np.zeros(len(labels))
        self.skip = 0.5
        #: Log potential of two linked tokens by their labels; None rewards equal kinds.
        self.pair: np.ndarray | None = None
        self._rows: dict[str, int] = {}
        self._table = np.zeros((0, len(OFFSETS), len(labels)), np.float32)
        self._used = 0

    # ---- fitting -------------------------------------------------------------------

    def fit(self, docs: list[tuple[list[str], list[list[str]], list[int]]], rounds: int = 120, l2: float = 2e-3, min_count: int = 1):
        """docs: (tokens, positional features of each token, label ids)."""
        n_labels = len(self.labels)
        types: dict[str, int] = {}
        seqs = [np.array([types.setdefault(t, len(types)) for t in toks]) for toks, _, _ in docs]
        pairs_f, pairs_t = {o: [] for o in OFFSETS}, {o: [] for o in OFFSETS}
        for t, k in types.items():
            for f in self.features(t):
                for o in OFFSETS:
                    if offset_has(o, f):
                        pairs_f[o].append(self.index.setdefault((o, f), len(self.index)))
                        pairs_t[o].append(k)
        pairs = {o: (np.array(pairs_f[o], int), np.array(pairs_t[o], int)) for o in OFFSETS}
        lengths = np.array([len(s) for s in seqs])
        order = np.argsort(lengths)
        seqs = [seqs[i] for i in order]
        docs = [docs[i] for i in order]
        n, width = len(seqs), int(lengths.max())
        pad = len(types)
        ids = np.full((n, width + 2 * OFFSETS[-1]), pad)
        gold = np.zeros((n, width), int)
        mask = np.zeros((n, width), bool)
        pos_tok, pos_f = [], []
        for r, (s, (_, extra, y)) in enumerate(zip(seqs, docs)):
            ids[r, OFFSETS[-1] : OFFSETS[-1] + len(s)] = s
            gold[r, : len(s)], mask[r, : len(s)] = y, True
            for c, fs in enumerate(extra):
                for f in fs:
                    pos_tok.append(r * width + c)
                    pos_f.append(self.position_index.setdefault(f, len(self.position_index)))
        pos_tok, pos_f = np.array(pos_tok, int), np.array(pos_f, int)
        shifted = {o: ids[:, OFFSETS[-1] + o : OFFSETS[-1] + o + width] for o in OFFSETS}
        params = [
            np.zeros((len(self.index), n_labels)), np.zeros((max(1, len(self.position_index)), n_labels)),
            np.zeros((n_labels, n_labels)), np.zeros(n_labels),
        ]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        total = mask.sum()
        onehot = np.eye(n_labels)[gold] * mask[..., None]
        gold_trans = np.zeros((n_labels, n_labels))
        both = mask[:, 1:] & mask[:, :-1]
        np.add.at(gold_trans, (gold[:, :-1][both], gold[:, 1:][both]), 1)
        gold_start = np.bincount(gold[:, 0], minlength=n_labels).astype(float)

        def add_to(size: int, keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
            return np.stack([np.bincount(keys, rows[:, k], size) for k in range(n_labels)], 1)

        for step in range(1, rounds + 1):
            w, pw, tr, st = params
            emission = np.zeros((n, width, n_labels))
            for o in OFFSETS:
                f, t = pairs[o]
                table = np.vstack([add_to(pad, t, w[f]) if len(f) else np.zeros((pad, n_labels)), np.zeros((1, n_labels))])
                emission += table[shifted[o]]
            if len(pos_f):
                emission += POSITION_VALUE * add_to(n * width, pos_tok, pw[pos_f]).reshape(n, width, n_labels)
            post, trans, first = self._posterior(emission, mask, tr, st)
            diff = (post - onehot) / total
            flat = diff.reshape(-1, n_labels)
            grads = [np.zeros_like(w), np.zeros_like(pw), (trans - gold_trans) / total, (first - gold_start) / total]
            for o in OFFSETS:
                f, t = pairs[o]
                if len(f):
                    by_type = add_to(pad + 1, shifted[o].ravel(), flat)
                    grads[0] += add_to(len(w), f, by_type[t])
            if len(pos_f):
                grads[1] += POSITION_VALUE * add_to(len(pw), pos_f, flat[pos_tok])
            rate = 0.15 * (1 - 0.8 * step / rounds)
            for k, (p, g) in enumerate(zip(params, grads)):
                g = g + l2 * p / 100
                m, v = moments[k]
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        self.weights, self.position_weights, self.trans, self.start = params
        return self

    def _posterior(self, emission, mask, trans, start):
        """Label marginals, expected transitions and expected first labels of padded sequences."""
        n, width, k = emission.shape
        shift = emission.max(2, keepdims=True)
        e = np.exp(emission - shift)
        t = np.exp(np.clip(trans, -30, 30))
        alpha, beta, scale = np.zeros((n, width, k)), np.ones((n, width, k)), np.ones((n, width))
        a = e[:, 0] * np.exp(start)
        scale[:, 0] = a.sum(1)
        alpha[:, 0] = a / scale[:, :1]
        for i in range(1, width):
            a = (alpha[:, i - 1] @ t) * e[:, i]
            s = a.sum(1)
            s[s <= 0] = 1
            live = mask[:, i]
            alpha[:, i] = np.where(live[:, None], a / s[:, None], alpha[:, i - 1])
            scale[:, i] = np.where(live, s, 1)
        for i in range(width - 2, -1, -1):
            b = (e[:, i + 1] * beta[:, i + 1]) @ t.T / scale[:, i + 1, None]
            beta[:, i] = np.where(mask[:, i + 1, None], b, 1)
        post = alpha * beta * mask[..., None]
        post /= np.maximum(post.sum(2, keepdims=True), 1e-300)
        right = e[:, 1:] * beta[:, 1:] / scale[:, 1:, None] * mask[:, 1:, None]
        expected = np.einsum("nia,nib->ab", alpha[:, :-1], right) * t
        return post, expected, post[:, 0].sum(0)

    def compact(self) -> "SkipChainCRF":
        """Drop features without weight, before the model is shipped."""
        keep = np.abs(self.weights).max(1) > 1e-3 if len(self.weights) else np.zeros(0, bool)
        old = {i: n for n, i in enumerate(np.flatnonzero(keep))}
        self.index = {f: old[i] for f, i in self.index.items() if i in old}
        self.weights = self.weights[keep].astype(np.float32)
        return self

    # ---- inference -----------------------------------------------------------------

    def _row(self, token: str) -> int:
        row = self._rows.get(token)
        if row is None:
            if self._used == len(self._table):
                self._table = np.concatenate((self._table, np.zeros((max(1024, self._used), *self._table.shape[1:]), np.float32)))
            row = self._rows[token] = self._used
            self._used += 1
            for f in self.features(token):
                for k, o in enumerate(OFFSETS):
                    if (i := self.index.get((o, f))) is not None:
                        self._table[row, k] += self.weights[i]
        return row

    def emissions(self, docs: list[tuple[list[str], list[tuple[int, str]]]]) -> list[np.ndarray]:
        """Scores (token, label) of each document; docs: (tokens, (token position, positional feature)).

        All documents of a batch are scored together, with blank rows between them that
        no offset crosses.
        """
        if self._used > 200_000:
            self._rows, self._used = {}, 0
            self._table = np.zeros((0, *self._table.shape[1:]), np.float32)
        gap = max(OFFSETS)
        rows, firsts, at, features = [], [], [], []
        index, size = self.position_index, gap
        for tokens, extra in docs:
            firsts.append(size)
            rows.extend(map(self._row, tokens))
            rows.extend((-1,) * gap)
            for p, f in extra:
                if (i := index.get(f)) is not None:
                    at.append(size + p)
                    features.append(i)
            size += len(tokens) + gap
        ids = np.concatenate((np.full(gap, -1), np.array(rows, np.int64), np.full(gap, -1)))
        table = np.concatenate((self._table[: self._used], np.zeros((1, *self._table.shape[1:]), np.float32)))
        ids[ids < 0] = self._used
        out = np.zeros((len(ids), len(self.labels)), np.float32)
        for k, o in enumerate(OFFSETS):
            out[gap : len(ids) - gap] += table[ids[gap + o : len(ids) - gap + o], k]
        if at:
            known = self.position_weights[features] * POSITION_VALUE
            for k in range(len(self.labels)):
                out[:, k] += np.bincount(at, known[:, k], len(ids)).astype(np.float32)
        return [out[a : a + len(tokens)] for a, (tokens, _) in zip(firsts, docs)]

    def marginals(self, docs: list[tuple[np.ndarray, list[tuple[int, int]]]], kinds: np.ndarray, rounds: int = 3) -> list[np.ndarray]:
        """Label marginals of each document; docs: (emissions, skip links); kinds[label]: entity kind or 0."""
        out = self._chains([e for e, _ in docs])
        # Links matter only among tokens that are linked, directly or not, to one that may be an entity at all.
        links_of = {}
        for i, (_, links) in enumerate(docs):
            if links:
                ends = np.array(links)
                open_ = 1 - out[i][:, kinds == 0].sum(1) > 0.02
                while (fresh := ends[open_[ends[:, 0]] != open_[ends[:, 1]]]).size:
                    open_[fresh] = True
                if len(ends := ends[open_[ends[:, 0]]]):
                    links_of[i] = ends
        linked = list(links_of)
        pair = self.pair if self.pair is not None else ((kinds[:, None] == kinds[None, :]) & (kinds[:, None] > 0)).astype(float)
        potential = np.exp(self.skip * pair)
        state = {i: np.ones((len(links_of[i]), 2, len(self.labels))) for i in linked}
        for _ in range(rounds if linked and self.skip else 0):
            fields = []
            for i in linked:
                emission, ends, inbound = docs[i][0], links_of[i], state[i]
                new = np.empty_like(inbound)
                for side in (0, 1):  # message to ends[:, 1 - side] from ends[:, side]
                    cavity = out[i][ends[:, side]] / np.maximum(inbound[:, side], 1e-30)
                    message = cavity @ potential
                    new[:, 1 - side] = message / message.sum(1, keepdims=True) * len(self.labels)
                state[i] = new
                field = emission.astype(np.float64).copy()
                np.add.at(field, ends[:, 0], np.log(new[:, 0]))
                np.add.at(field, ends[:, 1], np.log(new[:, 1]))
                fields.append(field)
            for i, p in zip(linked, self._chains(fields, [out[i] for i in linked], [links_of[i] for i in linked])):
                out[i] = p
        return out

    def _chains(self, emissions: list[np.ndarray], before: list[np.ndarray] | None = None, touched: list[np.ndarray] | None = None) -> list[np.ndarray]:
        """Forward-backward over chains of any length, in blocks that are batched by length.

        A block is computed with ``CONTEXT`` tokens on either side, beyond which a chain has
        forgotten its ends (a test compares blocks with whole chains).  With ``before`` and ``touched`` only blocks near the touched
        tokens are computed anew.
        """
        out = [np.zeros(e.shape) for e in emissions] if before is None else before
        blocks = []
        for i, e in enumerate(emissions):
            for a in range(0, len(e), BLOCK):
                b = min(a + BLOCK, len(e))
                lo, hi = max(0, a - CONTEXT), min(len(e), b + CONTEXT)
                if touched is None or ((touched[i] >= lo) & (touched[i] < hi)).any():
                    blocks.append((hi - lo, i, a, b, lo, hi))
        blocks.sort(key=lambda x: x[0])
        at = 0
        while at < len(blocks):
            most = 1.25 * blocks[at][0] + 16
            take = [x for x in blocks[at : at + 512] if x[0] <= most]
            at += len(take)
            parts = self._batch([emissions[i][lo:hi] for _, i, _, _, lo, hi in take], np.array([lo == 0 for *_, lo, _ in take]))
            for (_, i, a, b, lo, _), p in zip(take, parts):
                out[i][a:b] = p[a - lo : b - lo]
        return out

    def _batch(self, emissions: list[np.ndarray], at_start: np.ndarray) -> list[np.ndarray]:
        width = max(map(len, emissions))
        n, k = len(emissions), len(self.labels)
        e, mask = np.zeros((width, n, k)), np.zeros((width, n, 1), bool)
        for r, x in enumerate(emissions):
            e[: len(x), r], mask[: len(x), r] = x, True
        e = np.exp(e - e.max(2, keepdims=True))
        t = np.exp(np.clip(self.trans, -30, 30))
        alpha, beta = np.empty_like(e), np.ones_like(e)
        alpha[0] = e[0] * np.exp(np.where(at_start[:, None], self.start, 0.0))
        for i in range(1, width):
            np.matmul(alpha[i - 1], t, out=alpha[i])
            alpha[i] *= e[i]
            if i % RESCALE == 0:
                alpha[i] /= np.maximum(alpha[i].sum(1, keepdims=True), 1e-300)
        back, ragged = t.T.copy(), not mask.all()
        for i in range(width - 2, -1, -1):
            b = (e[i + 1] * beta[i + 1]) @ back
            if i % RESCALE == 0:
                b /= np.maximum(b.sum(1, keepdims=True), 1e-300)
            beta[i] = np.where(mask[i + 1], b, 1.0) if ragged else b
        post = alpha * beta
        post /= np.maximum(post.sum(2, keepdims=True), 1e-300)
        return [post[: len(x), r] for r, x in enumerate(emissions)]


def offset_has(offset: int, feature: str) -> bool:
    """Which feature families are seen at which distance."""
    if offset == 0:
        return True
    family = feature.partition(":")[0]
    if abs(offset) == 1:
        return family in ("w", "sh", "cue", "list", "s3")
    if abs(offset) == 2:
        return family in ("w", "sh", "cue", "list")
    return family in ("w", "cue")
