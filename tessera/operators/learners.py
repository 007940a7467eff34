"""Small learners on all rows of one training side: one fit of a grid search is one task's work.

The search (``tuning.py``) fans the (grid point, fold) fits out over tasks; each of them opens the training rows as a
file mapped into memory (``Rows``) and runs one of these functions in numpy, block by block, so that a task holds
some ten numbers a row and never the rows themselves.  Trees grow one level at a time from histograms keyed by
(node, column, bin).  Boosting counts columns of two values that are never set together (one-hot slots) as one column, and
of two sibling nodes only the lighter one: the other is their parent's histogram less that.  A forest grows
several trees side by side while the rows are few.
"""

from __future__ import annotations

import numpy as np

MAX_BINS = 64
SIDE_BY_SIDE = 8  # trees of a forest that grow together
SIDE_ROWS = 2_000_000  # rows of all trees that grow together, unless it is one
BLOCK = 131072    # rows that are worked on at a time
JOINT = 512       # codes that are counted at a time
CELLS = 4_000_000  # (node, column, bin) counts of a forest's level that are held at a time
DENSE_BYTES = 256 * 1024 * 1024  # rows of a net that are copied into memory


class Rows:
    """Rows of one fit: ``x[own]`` (all of ``x`` if None) with their labels, then a row of label 1 for every (i, j, gap) of ``drawn``,
    the step ``gap`` from row i of ``x`` towards row j.  They are built where they are asked for."""

    def __init__(self, x, label, own=None, drawn=None):
        self.x, self.own, self.drawn = x, own, drawn
        label = label if own is None else label[own]
        self.real = len(label)
        self.y = np.concatenate([label, np.ones(len(drawn[0]))]) if drawn is not None else np.asarray(label, float)
        self.width = x.shape[1]

    def __len__(self) -> int:
        return len(self.y)

    def _between(self, at, columns=slice(None)) -> np.ndarray:
        i, j, gap = (v[at] for v in self.drawn)
        a, z = self.x[i, columns], self.x[j, columns]
        gap = gap.astype(np.float32)
        return a + (gap[:, None] if a.ndim == 2 else gap) * (z - a)

    def span(self, lo: int, hi: int) -> np.ndarray:
        """Rows lo to hi."""
        hi = min(hi, len(self))
        cut = min(hi, self.real)
        kept = self.x[lo:max(lo, cut)] if self.own is None else self.x[self.own[lo:max(lo, cut)]]
        return kept if hi <= self.real else np.concatenate([kept, self._between(slice(max(lo, self.real) - self.real, hi - self.real))])

    def take(self, at: np.ndarray) -> np.ndarray:
        if self.drawn is None:
            return self.x[at if self.own is None else self.own[at]]
        out, new = np.empty((len(at), self.width), self.x.dtype), at >= self.real
        out[~new] = self.x[at[~new] if self.own is None else self.own[at[~new]]]
        out[new] = self._between(at[new] - self.real)
        return out

    def column(self, c: int) -> np.ndarray:
        kept = self.x[:, c] if self.own is None else self.x[self.own, c]
        return np.asarray(kept) if self.drawn is None else np.concatenate([kept, self._between(slice(None), c)])

    def dense(self) -> np.ndarray:
        return self.span(0, len(self))


def rows_of(x, y) -> Rows:
    return x if isinstance(x, Rows) else Rows(x, np.asarray(y, float))


# ------------------------------------------------------------------- binning
def edges_of(x, max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Upper edges of every column's bins but the last: its distinct values, or quantiles of many."""
    out, rows = [], x if isinstance(x, Rows) else Rows(x, np.zeros(len(x)))
    for c in range(rows.width):
        column = rows.column(c)
        kinds = np.unique(column)
        if len(kinds) > max_bins:
            kinds = np.unique(np.quantile(column, np.linspace(0, 1, max_bins + 1)[1:], method="higher"))
        out.append(kinds[:-1])
    return out


def codes_of(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], axis=1).astype(np.uint8)


def row_codes(rows: Rows, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty((len(rows), rows.width), np.uint8)
    for lo in range(0, len(rows), BLOCK):
        out[lo:lo + BLOCK] = codes_of(rows.span(lo, lo + BLOCK), edges)
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -80, 80)))


def auc(label: np.ndarray, score: np.ndarray) -> float:
    """Mann-Whitney with half counts for ties."""
    kinds, at = np.unique(score, return_inverse=True)
    pos, neg = np.bincount(at, label, len(kinds)), np.bincount(at, 1 - label, len(kinds))
    if not pos.sum() or not neg.sum():
        return float("nan")
    return float((pos * (np.cumsum(neg) - neg / 2)).sum() / (pos.sum() * neg.sum()))


# ------------------------------------------------------------- boosted trees
def bundles_of(rows: Rows, edges: list[np.ndarray], most: int = 255) -> tuple[list[np.ndarray], list[list[int]]]:
    """Codes and columns of every bundle: a column of more than two values by itself (its bins), columns of two values that
    no row sets together in one (0 for none, k for its k-th column).  Constant columns are in none."""
    codes, members, shared = [], [], []
    for c, e in enumerate(edges):
        if not len(e):
            continue
        code = np.searchsorted(e, rows.column(c)).astype(np.uint8)
        if len(e) > 1:
            codes.append(code)
            members.append([c])
            continue
        rows_set = np.flatnonzero(code)
        home = next((b for b in shared if len(members[b]) < most and not codes[b][rows_set].any()), None)
        if home is None:
            shared.append(len(codes))
            codes.append(code)
            members.append([c])
        else:
            members[home].append(c)
            codes[home][rows_set] = len(members[home])
    return codes, members


def joined(widths: list[int], most: int) -> list[list[int]]:
    """Bundles that are counted together, as long as their codes make no more than ``most`` pairs, triples, ..."""
    out, cells = [], []
    for b in sorted(range(len(widths)), key=lambda b: -widths[b]):
        home = next((k for k, c in enumerate(cells) if c * widths[b] <= most), None)
        if home is None:
            out.append([b])
            cells.append(widths[b])
        else:
            out[home].append(b)
            cells[home] *= widths[b]
    return out


def boost(x, y, rounds: int, depth: int, rate: float, rows: float, columns: float,
          shrink: float = 1.0, least: float = 1.0, max_bins: int = MAX_BINS, seed: int = 42) -> dict:
    """Trees on the second-order expansion of the logistic loss, from a margin of 0; ``rows`` and ``columns``
    are the shares that a tree draws."""
    rng = np.random.default_rng(seed)
    fitted = rows_of(x, y)
    y = fitted.y
    edges = edges_of(fitted, max_bins)
    codes, members = bundles_of(fitted, edges)
    n, d = len(fitted), fitted.width
    size = np.array([len(e) + 1 for e in edges])
    first = np.cumsum(size) - size
    bins = int(size.sum())
    column_of = np.repeat(np.arange(d), size)
    last_bin = np.zeros(bins, dtype=bool)
    last_bin[first + size - 1] = True
    width = [int(size[m[0]]) if len(m) == 1 else len(m) + 1 for m in members]
    place = [first[m[0]] + np.arange(w) if len(m) == 1 else first[m] + 1 for m, w in zip(members, width)]  # bins of a bundle's counts
    rest = [None if len(m) == 1 else first[m] for m in members]  # bins that are their node's total less another
    bundle_of, number_of = np.zeros(d, np.int64), np.zeros(d, np.int64)
    for b, m in enumerate(members):
        bundle_of[m], number_of[m] = b, np.arange(1, len(m) + 1) if len(m) > 1 else 0
    by_row = np.stack(codes, axis=1) if codes else np.zeros((n, 1), np.uint8)
    together = joined(width, JOINT)
    cells = [int(np.prod([width[b] for b in own])) for own in together]
    joint = []
    for own in together:
        code = np.zeros(n, np.uint16)
        for b in own:
            code = code * np.uint16(width[b]) + codes[b]
        joint.append(code)
    del codes
    margin, grad, bend = np.zeros(n), np.zeros(n), np.zeros(n)
    node, final = np.zeros(n, np.int16), np.zeros(n, np.int16)
    drawn = np.ones(n, dtype=bool)
    feature = np.full((rounds, 2 ** (depth + 1) - 1), -1, dtype=np.int16)
    cut = np.zeros(feature.shape, dtype=np.uint8)
    value = np.zeros(feature.shape, dtype=np.float32)
    blocks = [slice(lo, min(lo + BLOCK, n)) for lo in range(0, n, BLOCK)]
    kinds = np.arange(256)

    def histogram(sums, totals, q):
        """Per (node, bin) from the sums per (node, codes of the bundles that are counted together)."""
        out = np.zeros((2, q, bins))
        for each, both in zip(together, sums):
            both = both.reshape(2, q, *[width[b] for b in each])
            for a, b in enumerate(each):
                own = both.sum(axis=tuple(2 + z for z in range(len(each)) if z != a))
                if rest[b] is None:
                    out[:, :, place[b]] = own
                else:
                    out[:, :, place[b]] = own[:, :, 1:]
                    out[:, :, rest[b]] = totals[:, :, None] - own[:, :, 1:]
        return out

    for t in range(rounds):
        if rows < 1:
            for own in blocks:
                drawn[own] = rng.random(own.stop - own.start) < rows
        barred = last_bin
        if columns < 1:
            out = np.ones(d, dtype=bool)
            out[rng.choice(d, max(1, int(round(columns * d))), replace=False)] = False
            barred = last_bin | out[column_of]
        sums = [np.zeros((2, w)) for w in cells]
        total = np.zeros((2, 1))
        for own in blocks:
            p = sigmoid(margin[own])
            g, h = p - y[own], p * (1 - p)
            if rows < 1:
                g, h = g * drawn[own], h * drawn[own]
            grad[own], bend[own] = g, h
            total[0, 0] += g.sum()
            total[1, 0] += h.sum()
            for both, code in zip(sums, joint):
                at = code[own].astype(np.int64)
                both[0] += np.bincount(at, g, both.shape[1])
                both[1] += np.bincount(at, h, both.shape[1])
        node[:] = 0  # within the level; -1 in finished leaves
        final[:] = -1  # in the tree, of rows in finished leaves
        ended = False
        hist = histogram(sums, total, 1)
        for level in range(depth + 1):
            k = 2 ** level
            value[t, k - 1:2 * k - 1] = -rate * total[0] / (total[1] + shrink)
            if level == depth or not together:
                break
            left = np.cumsum(hist, axis=2)
            left -= np.repeat(left[:, :, first] - hist[:, :, first], size, axis=2)
            gl, hl = left
            gr, hr = total[0][:, None] - gl, total[1][:, None] - hl
            gain = gl * gl / (hl + shrink) + gr * gr / (hr + shrink)
            gain[(hl < least) | (hr < least)] = -np.inf
            gain[:, barred] = -np.inf
            best = gain.argmax(axis=1)
            every = np.arange(k)
            good = gain[every, best] - total[0] ** 2 / (total[1] + shrink) > 1e-6
            if not good.any():
                break
            column = column_of[best]
            feature[t, k - 1:2 * k - 1] = np.where(good, column, -1)
            cut[t, k - 1:2 * k - 1] = best - first[column]
            number = number_of[column][:, None]
            goes_right = np.where(number > 0, kinds == number, kinds > (best - first[column])[:, None]).ravel()
            lookup = bundle_of[column]
            total = np.where(np.repeat(good, 2), np.stack([left[:, every, best], np.stack([gr, hr])[:, every, best]], axis=2).reshape(2, 2 * k), 0.0)
            # of two children the one of less weight is counted
            lighter = np.zeros(2 * k, dtype=bool)
            pick = 2 * every + (total[1][1::2] < total[1][::2])
            lighter[pick[good]] = True
            slot = np.cumsum(lighter) - 1
            q, deeper = int(lighter.sum()), level + 1 < depth
            sums = [np.zeros((2, q * w)) for w in cells] if deeper else []
            for own in blocks:
                at = node[own]
                parent = at.astype(np.int64)
                here = np.arange(own.start, own.stop)
                if ended:
                    live = np.flatnonzero(at >= 0)
                    parent, here = parent[live], here[live]
                if not good.all():
                    goes = good[parent]
                    stays = here[~goes]
                    node[stays], final[stays] = -1, k - 1 + parent[~goes]
                    parent, here = parent[goes], here[goes]
                code = by_row.take(here * by_row.shape[1] + lookup.take(parent))
                child = 2 * parent + goes_right.take(parent * 256 + code)
                if ended or not good.all():
                    node[here] = child
                else:
                    at[:] = child
                if not deeper:
                    continue
                counts = lighter[child]
                if rows < 1:
                    counts &= drawn[here]
                some = np.flatnonzero(counts)
                if not len(some):
                    continue
                cell = slot.take(child.take(some))
                some = here.take(some)
                g, h = grad.take(some), bend.take(some)
                for both, code, w in zip(sums, joint, cells):
                    at = cell * w
                    at += code.take(some)
                    both[0] += np.bincount(at, g, both.shape[1])
                    both[1] += np.bincount(at, h, both.shape[1])
            ended = ended or not good.all()
            if deeper:
                light = histogram(sums, total[:, lighter], q)
                whole = np.zeros((2, 2 * k, bins))
                whole[:, lighter] = light
                whole[:, (pick ^ 1)[good]] = hist[:, good] - light
                hist = whole
        for own in blocks:
            at = final[own]
            at = np.where(at < 0, 2 ** level - 1 + node[own], at)
            margin[own] += value[t].take(at)
    return {"kind": "boost", "edges": edges, "feature": feature, "cut": cut, "value": value, "depth": depth}


def _boost_score(model: dict, x: np.ndarray) -> np.ndarray:
    code = codes_of(x, model["edges"])
    margin, rows = np.zeros(len(x)), np.arange(len(x))
    for feature, cut, value in zip(model["feature"], model["cut"], model["value"]):
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(model["depth"]):
            f = feature[at]
            at = np.where(f < 0, at, 2 * at + 1 + (code[rows, f] > cut[at]))
        margin += value[at]
    return sigmoid(margin)


# -------------------------------------------------------------------- forest
def _splits(node, row, weight, hit, columns, size, code, w_all, p_all, count, leaf):
    """Best drawn column, its cut and whether it lowers the impurity, of every node; ``node`` counts from 0, ``columns`` are the
    m of each node, the last three its sums."""
    q, m = columns.shape
    cells = size[columns].ravel()  # bins of every (node, drawn column), one after another
    begin = np.cumsum(cells) - cells
    starts = begin.reshape(q, m)
    total = int(cells.sum())
    sums = [np.zeros(total), np.zeros(total), np.zeros(total, np.int64)]
    step = max(BLOCK, total // 4)
    for lo in range(0, len(row), step):
        own, r = node[lo:lo + step], row[lo:lo + step]
        at = (starts[own] + code[r[:, None], columns[own]]).ravel()
        for s, v in zip(sums, (weight, hit, None)):
            s += np.bincount(at, None if v is None else np.repeat(v[lo:lo + step], m), total)
    of_node = np.repeat(np.arange(q), cells.reshape(q, m).sum(1))
    left_sums = []
    for s in sums:
        run = np.cumsum(s)
        left_sums.append(run - np.repeat(np.append(0, run)[begin], cells))
    w, p, c = left_sums
    wr, pr, cr = w_all[of_node] - w, p_all[of_node] - p, count[of_node] - c
    with np.errstate(divide="ignore", invalid="ignore"):
        purity = (p * p + (w - p) ** 2) / w + (pr * pr + (wr - pr) ** 2) / wr
    purity[(c < leaf) | (cr < leaf)] = -np.inf
    best = np.maximum.reduceat(purity, starts[:, 0])
    top = np.flatnonzero(purity == best[of_node])
    first = top[np.searchsorted(top, starts[:, 0])]
    drawn_at = np.searchsorted(begin, first, side="right") - 1
    return columns.ravel()[drawn_at], first - begin[drawn_at], best > (p_all ** 2 + (w_all - p_all) ** 2) / w_all + 1e-12


def forest(x, y, trees: int, depth: int | None, leaf: int, max_bins: int = MAX_BINS, seed: int = 42) -> dict:
    """Gini trees on bootstrap samples; every node draws the square root of the columns.  A node whose drawn
    columns offer no split is a leaf."""
    rng = np.random.default_rng(seed)
    rows = rows_of(x, y)
    y = rows.y
    edges = edges_of(rows, max_bins)
    code = row_codes(rows, edges)
    n, d = code.shape
    m = max(1, int(np.sqrt(d)))
    size = np.array([len(e) + 1 for e in edges])
    strides = np.array([s for s in range(1, d + 1) if np.gcd(s, d) == 1])
    grown = []
    side_by_side = max(1, min(SIDE_BY_SIDE, SIDE_ROWS // max(1, n)))
    for lo in range(0, trees, side_by_side):
        many = min(side_by_side, trees - lo)
        drawn = np.stack([np.bincount(rng.integers(0, n, n), minlength=n) for _ in range(many)])
        tree, row = np.nonzero(drawn)
        weight = drawn[tree, row].astype(np.float64)
        del drawn
        hit = weight * y[row]
        feature, cut, left, value = [], [], [], []
        node, made, level = tree.copy(), many, 0
        while len(row):
            k = int(node.max()) + 1
            w_all, p_all = np.bincount(node, weight, k), np.bincount(node, hit, k)
            count = np.bincount(node, minlength=k)
            share = p_all / w_all
            inner = (p_all > 0) & (p_all < w_all) & (count >= 2 * leaf)
            if depth is not None and level >= depth:
                inner[:] = False
            column, at_cut, good = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros(k, dtype=bool)
            if inner.any():
                # only nodes that may split are counted; m columns of each, a step apart round the table
                place = np.cumsum(inner) - 1
                live = np.flatnonzero(inner[node])
                own, q = place[node[live]], int(inner.sum())
                columns = (rng.integers(0, d, (q, 1)) + strides[rng.integers(0, len(strides), (q, 1))] * np.arange(m)) % d
                # nodes go in groups of so many counts; their rows lie together where there are several groups
                of_cell = np.cumsum(size[columns].sum(1)) // CELLS
                cuts = [0, *(np.flatnonzero(np.diff(of_cell)) + 1), q]
                if len(cuts) > 2:
                    order = np.argsort(own, kind="stable")
                    live, own = live[order], own[order]
                ends = np.searchsorted(own, cuts) if len(cuts) > 2 else [0, len(own)]
                found = []
                for a, b, lo_row, hi_row in zip(cuts, cuts[1:], ends, ends[1:]):
                    at, nodes = live[lo_row:hi_row], np.flatnonzero(inner)[a:b]
                    found.append(_splits(own[lo_row:hi_row] - a, row[at], weight[at], hit[at], columns[a:b], size, code,
                                         w_all[nodes], p_all[nodes], count[nodes], leaf))
                column[inner], at_cut[inner], good[inner] = (np.concatenate(z) for z in zip(*found))
            born = np.cumsum(good) - good
            feature.append(np.where(good, column, -1).astype(np.int16))
            cut.append(at_cut.astype(np.uint8))
            left.append(np.where(good, made + 2 * born, 0).astype(np.int32))
            value.append(share.astype(np.float32))
            made += 2 * int(good.sum())
            goes = good[node]
            row, node, weight, hit = row[goes], node[goes], weight[goes], hit[goes]
            node = 2 * born[node] + (code[row, column[node]] > at_cut[node])
            level += 1
        grown.append((many, *[np.concatenate(z) for z in (feature, cut, left, value)]))
    return {"kind": "forest", "edges": edges, "trees": trees, "grown": grown}


def _forest_score(model: dict, x: np.ndarray) -> np.ndarray:
    code = codes_of(x, model["edges"])
    total, rows = np.zeros(len(x)), np.arange(len(x))
    for many, feature, cut, left, value in model["grown"]:
        for t in range(many):
            at = np.full(len(x), t)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                at = np.where(inner, left[at] + (code[rows, f] > cut[at]), at)
            total += value[at]
    return total / model["trees"]


# ----------------------------------------------------------------------- net
def net(x, y, layers: tuple[int, ...], penalty: float, epochs: int = 300, batch: int = 200,
        rate: float = 1e-3, tolerance: float = 1e-4, patience: int = 10, seed: int = 42) -> dict:
    """Rectified layers and a logistic output; Adam on mini-batches of the mean loss plus
    ``penalty`` / (2 rows) times the squared weights, until the loss stops falling."""
    rng = np.random.default_rng(seed)
    rows = rows_of(x, y)
    if 4 * len(rows) * rows.width <= DENSE_BYTES:
        rows = Rows(rows.dense().astype(np.float32), rows.y)
    y = rows.y.astype(np.float32)[:, None]
    shape = [rows.width, *layers, 1]
    params = []
    for a, b in zip(shape, shape[1:]):
        bound = np.sqrt((2 if b == 1 else 6) / (a + b))
        params += [rng.uniform(-bound, bound, (a, b)).astype(np.float32), rng.uniform(-bound, bound, b).astype(np.float32)]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    best, waited, step = np.inf, 0, 0
    for _ in range(epochs):
        order, loss = rng.permutation(len(y)), 0.0
        for lo in range(0, len(y), batch):
            own = order[lo:lo + batch]
            acts = [rows.take(own).astype(np.float32, copy=False)]
            for k in range(0, len(params), 2):
                z = acts[-1] @ params[k] + params[k + 1]
                acts.append(np.maximum(z, 0) if k + 2 < len(params) else sigmoid(z))
            p = np.clip(acts[-1], 1e-7, 1 - 1e-7)
            loss += float(-(y[own] * np.log(p) + (1 - y[own]) * np.log(1 - p)).sum())
            slope = (acts[-1] - y[own]) / len(own)
            step += 1
            scale = rate * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for k in range(len(params) - 2, -1, -2):
                grads = acts[k // 2].T @ slope + penalty / len(own) * params[k], slope.sum(0)
                if k:
                    slope = (slope @ params[k].T) * (acts[k // 2] > 0)
                for i, g in zip((k, k + 1), grads):
                    mean[i] += 0.1 * (g - mean[i])
                    square[i] += 0.001 * (g * g - square[i])
                    params[i] -= scale * mean[i] / (np.sqrt(square[i]) + 1e-8)
        loss = loss / len(y) + penalty / (2 * len(y)) * sum(float((w * w).sum()) for w in params[::2])
        waited = waited + 1 if loss > best - tolerance else 0
        best = min(best, loss)
        if waited >= patience:
            break
    return {"kind": "net", "params": params}


def _net_score(model: dict, x: np.ndarray) -> np.ndarray:
    a, params = x.astype(np.float32), model["params"]
    for k in range(0, len(params), 2):
        z = a @ params[k] + params[k + 1]
        a = np.maximum(z, 0) if k + 2 < len(params) else sigmoid(z)
    return a[:, 0].astype(np.float64)


# ------------------------------------------------------------------ logistic
def logistic(x, y, c: float, tolerance: float = 1e-10, steps: int = 100) -> dict:
    """Newton's method on half the squared weights plus ``c`` times the loss with balanced class weights;
    the intercept is free."""
    rows = rows_of(x, y)
    y = rows.y
    weight = np.where(y == 1, len(y) / (2 * max(1.0, (y == 1).sum())), len(y) / (2 * max(1.0, (y == 0).sum())))
    ridge = np.ones(rows.width + 1)
    ridge[-1] = 0
    w = np.zeros(len(ridge))

    def blocks():
        for lo in range(0, len(y), BLOCK):
            own = rows.span(lo, lo + BLOCK).astype(np.float64)
            yield np.column_stack([own, np.ones(len(own))]), y[lo:lo + BLOCK], weight[lo:lo + BLOCK]

    def loss(v):
        total = 0.0
        for own, label, share in blocks():
            z = own @ v
            total += (share * (np.logaddexp(0, z) - label * z)).sum()
        return 0.5 * (ridge * v * v).sum() + c * total
    now = loss(w)
    for _ in range(steps):
        slope, bend = np.zeros(len(w)), np.zeros((len(w), len(w)))
        for own, label, share in blocks():
            p = sigmoid(own @ w)
            slope += own.T @ (share * (p - label))
            bend += (own * (share * p * (1 - p))[:, None]).T @ own
        slope, bend = ridge * w + c * slope, np.diag(ridge) + c * bend
        move, scale = np.linalg.lstsq(bend, slope, rcond=None)[0], 1.0
        while loss(w - scale * move) > now and scale > 1e-8:
            scale /= 2
        w = w - scale * move
        before, now = now, loss(w)
        if before - now <= tolerance * max(1.0, abs(now)):
            break
    return {"kind": "logistic", "weights": w}


def _logistic_score(model: dict, x: np.ndarray) -> np.ndarray:
    return sigmoid(x.astype(np.float64) @ model["weights"][:-1] + model["weights"][-1])


SCORES = {"boost": _boost_score, "forest": _forest_score, "net": _net_score, "logistic": _logistic_score}


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of the positive class."""
    own = SCORES[model["kind"]]
    if len(x) <= BLOCK:
        return own(model, x)
    return np.concatenate([own(model, x[lo:lo + BLOCK]) for lo in range(0, len(x), BLOCK)])
