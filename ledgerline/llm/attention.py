"""A small causal self-attention model over subword classes, in numpy: training and batched scoring.

Every subword id has a class and a fixed input vector; the model predicts
the next class from the ids before it (one attention head with a learned
bias per distance, a residual, one hidden layer, a softmax over classes), and
the id inside its class comes from corpus counts.
"""

from __future__ import annotations

import math

import numpy as np

WIDTH = 32   # ids a window sees
STRIDE = 16  # ids a window scores: its last ones
D, HEAD, HIDDEN = 16, 16, 16
BATCH = 128  # training windows of a step
PIECE = 128  # windows of one gradient
MISSING = 65535  # stands in training windows where a text's last window has no id


def shapes(inputs: int, classes: int) -> dict[str, tuple[int, ...]]:
    return {"win": (inputs, D), "bin": (D,), "wq": (D, HEAD), "wk": (D, HEAD), "wv": (D, HEAD), "wo": (HEAD, D),
            "bias": (WIDTH,), "w1": (D, HIDDEN), "b1": (HIDDEN,), "wc": (D + HIDDEN, classes), "bc": (classes,)}


def unpack(flat: np.ndarray, inputs: int, classes: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(inputs, classes).items():
        n = math.prod(shape)
        out[name] = flat[at: at + n].reshape(shape)
        at += n
    return out


def initial(inputs: int, class_counts: np.ndarray, seed: int = 5) -> np.ndarray:
    """Starts as a unigram model over classes."""
    rng = np.random.default_rng(seed)
    parts = []
    for name, shape in shapes(inputs, len(class_counts)).items():
        if name == "bc":
            parts.append(np.log((class_counts + 1.0) / (class_counts.sum() + len(class_counts))))
        elif len(shape) == 1:
            parts.append(np.zeros(shape))
        else:
            scale = 0.02 if name == "wc" else 1 / np.sqrt(shape[0])
            parts.append(rng.normal(0, scale, shape).ravel())
    return np.concatenate(parts).astype(np.float32)


_DISTANCE = np.clip(np.arange(WIDTH)[:, None] - np.arange(WIDTH)[None, :], 0, WIDTH - 1)
_FUTURE = np.triu(np.ones((WIDTH, WIDTH), bool), 1)
_SEEN = (~_FUTURE).astype(np.float32)
LIMIT = np.float32(60)  # of attention scores, where exp would not stay finite


def _by_window(rows: np.ndarray) -> np.ndarray:
    """(features, windows * n) as (windows, features, n), without a copy."""
    return rows.reshape(len(rows), -1, WIDTH).transpose(1, 0, 2)


def _class_weights(p: dict[str, np.ndarray]) -> np.ndarray:
    """Biases above the class weights, a row per class; rows without a share fill up to whole vectors (faster)."""
    classes = len(p["bc"])
    out = np.zeros((-(-classes // 4) * 4, 1 + D + HIDDEN), p["wc"].dtype)
    out[:classes, 0], out[:classes, 1:] = p["bc"], p["wc"].T
    out[classes:, 0] = -1e30
    return out


def _in_range(total: np.ndarray) -> bool:
    """Whether sums of unclipped exponentials (and what they divide) stay far inside a float; not for NaN."""
    return bool(total.max() < 1e30 and total.min() > 1e-30)


def _weights(score: np.ndarray, factor: np.ndarray, valid: np.ndarray | None, clip: bool) -> np.ndarray:
    """exp(score) * factor, in place of the scores; 0 for inputs that do not exist."""
    if clip:
        np.clip(score, -LIMIT, LIMIT, out=score)
    np.exp(score, out=score)
    score *= factor
    if valid is not None:
        score *= valid[:, None, :]
        score[:, 0, 0] += 1e-30    # a window without any input still divides by more than 0
    return score


def loss_and_gradient(flat: np.ndarray, x: np.ndarray, target: np.ndarray, valid: np.ndarray, classes: int
                      ) -> tuple[float, np.ndarray]:
    """Mean negative log likelihood of ``target`` classes and its gradient.

    ``x`` (windows, WIDTH, inputs, or inputs and a 1), ``target`` (windows,
    WIDTH), ``valid`` (windows, WIDTH): inputs that exist.  Arrays hold a row
    per feature and all places side by side: whatever is done to a feature
    or with one number per place runs along whole rows.
    """
    with np.errstate(over="ignore", invalid="ignore"):  # found by _in_range
        inputs = (len(flat) - sum(map(math.prod, shapes(0, classes).values()))) // D
        p = unpack(flat, inputs, classes)
        windows, kind = x.shape[0], flat.dtype
        if x.shape[2] == inputs:
            x = np.concatenate([x, np.ones((*x.shape[:2], 1), x.dtype)], axis=2)
        x = x.reshape(-1, inputs + 1)
        scale = np.float32(1 / np.sqrt(HEAD))
        # State, query, key and value are one product; beside the value a 1, which adds up the weights.
        enter = np.concatenate([p["win"], p["bin"][None]])
        heads = np.concatenate([p["wq"] * scale, p["wk"], p["wv"]], axis=1)
        into = np.concatenate([enter, enter @ heads, np.zeros((inputs + 1, 1), kind)], axis=1)
        into[-1, -1] = 1
        side = into.T @ x.T
        q, k, v = (_by_window(side[a:b]) for a, b in ((D, D + HEAD), (D + HEAD, D + 2 * HEAD), (D + 2 * HEAD, None)))
        factor = np.exp(p["bias"])[_DISTANCE] * _SEEN
        missing = None if valid.all() else valid
        mixed = np.empty((HEAD + 1, len(x)), kind)
        for clip in (False, True):
            a = _weights(q.transpose(0, 2, 1) @ k, factor, missing, clip)
            np.matmul(v, a.transpose(0, 2, 1), out=_by_window(mixed))
            if _in_range(mixed[HEAD]):
                break
        share, mixed = 1 / mixed[HEAD], mixed[:HEAD]  # weights are divided by their sum only where they are used up
        mixed *= share
        f = np.empty((1 + D + HIDDEN, len(x)), kind)  # a 1, whose weights are the biases, state and hidden layer
        h, z = f[: 1 + D], f[1 + D:]
        f[0] = 1
        np.matmul(p["wo"].T, mixed, out=h[1:])
        h[1:] += side[:D]
        np.matmul(np.concatenate([p["b1"][None], p["w1"]]).T, h, out=z)
        np.maximum(z, 0, out=z)
        wc = _class_weights(p)
        for shift in (False, True):
            g = wc @ f
            if shift:
                g -= g.max(axis=0)
            np.exp(g, out=g)
            total = g.sum(axis=0)
            if _in_range(total):
                break
        own = target.ravel() * g.shape[1] + np.arange(g.shape[1])
        used = valid.ravel()
        n = max(1, int(valid.sum()))
        loss = float(-(np.log(g.ravel().take(own) / total + 1e-30) * used).sum() / n)
        weight = (used / np.float32(n)).astype(kind)
        g *= weight / total
        g.ravel()[own] -= weight
        dw = f @ g.T
        out = {"wc": dw[1:, :classes], "bc": dw[0, :classes]}
        df = wc.T[1:] @ g
        dh, dz = df[:D], df[D:]
        dz *= np.sign(z)
        dw = h @ dz.T
        out["w1"], out["b1"] = dw[1:], dw[0]
        dh += p["w1"] @ dz
        out["wo"] = mixed @ dh.T
        # Beside the value's gradient what a row of a * ds would add up to: mixed times dmixed.
        dmixed = np.empty((HEAD + 1, len(x)), kind)
        np.matmul(p["wo"], dh, out=dmixed[:HEAD])
        dmixed[:HEAD] *= share
        np.negative((mixed * dmixed[:HEAD]).sum(axis=0), out=dmixed[HEAD])
        ds = _by_window(dmixed).transpose(0, 2, 1) @ v
        ds *= a                        # 0 where blocked, as the weight is
        by_place = np.ones((1, windows), kind) @ ds.reshape(windows, -1)
        out["bias"] = np.bincount(_DISTANCE.ravel(), weights=by_place[0], minlength=WIDTH)
        # Gradients take the places of state, query, key and value.
        dq = np.empty((HEAD, len(x)), kind)
        np.matmul(k, ds.transpose(0, 2, 1), out=_by_window(dq))
        np.matmul(q, ds, out=k)
        np.matmul(_by_window(dmixed[:HEAD]), a, out=v[:, :HEAD])
        side[:D], side[D: D + HEAD] = dh, dq
        dw = (side[:-1] @ x).T
        dheads = dw[:, D:]
        denter = dw[:, :D] + dheads @ heads.T
        out["win"], out["bin"] = denter[:-1], denter[-1]
        dw = enter.T @ dheads
        out["wq"], out["wk"], out["wv"] = dw[:, :HEAD] * scale, dw[:, HEAD: 2 * HEAD], dw[:, 2 * HEAD:]
        return loss, np.concatenate([out[name].ravel() for name in shapes(inputs, classes)]).astype(np.float32)


def train(flat: np.ndarray, tokens: np.ndarray, vectors: np.ndarray, classes_of: np.ndarray, classes: int, *,
          steps: int, batch: int = BATCH, rate: float = 5e-3, seed: int = 0) -> np.ndarray:
    """Adam over windows ``tokens`` (n, WIDTH + 1); goes round them until ``steps`` are done.

    Ids ``MISSING`` (at the end of a window only) are neither seen nor predicted.
    """
    rng = np.random.default_rng(seed)
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    flat = flat.copy()
    vectors = np.concatenate([vectors, np.ones((len(vectors), 1), vectors.dtype)], axis=1)  # the biases' input
    order, at = rng.permutation(len(tokens)), 0
    for step in range(1, steps + 1):
        if at >= len(order):
            order, at = rng.permutation(len(tokens)), 0
        rows = tokens[order[at: at + batch]]
        at += batch
        valid = rows[:, 1:] != MISSING
        rows = np.where(rows == MISSING, 0, rows)
        x, y = vectors.take(rows[:, :-1], axis=0), classes_of.take(rows[:, 1:])
        g = np.zeros_like(flat)
        for a in range(0, len(rows), PIECE):
            own = slice(a, a + PIECE)
            share = valid[own].sum() / max(1, valid.sum())
            g += np.float32(share) * loss_and_gradient(flat, x[own], y[own], valid[own], classes)[1]
        g *= min(1.0, 1.0 / (float(np.linalg.norm(g)) + 1e-9))
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        pace = rate * min(1.0, step / 20) * (1 - 0.9 * step / steps)
        flat -= (pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return flat


def entries(flat: np.ndarray, vectors: np.ndarray, classes: int) -> np.ndarray:
    """One row per id: state, query, key and what its value adds to the state side by side, and a 1."""
    p = unpack(flat, vectors.shape[1], classes)
    state = vectors @ p["win"] + p["bin"]
    return np.concatenate([state, (state @ p["wq"]) * np.float32(1 / np.sqrt(HEAD)), state @ p["wk"],
                           state @ (p["wv"] @ p["wo"]), np.ones((len(state), 1))], axis=1).astype(np.float32)


def score(flat: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, vectors: np.ndarray, classes_of: np.ndarray,
          classes: int, step: int = 96, table: np.ndarray | None = None) -> np.ndarray:
    """log p(class) of every token given those before it; ``tokens`` are texts laid end to end.

    Each text is a run of ``lengths[i]`` tokens; the first is its start mark
    and gets 0.  A text is cut into windows of WIDTH inputs that overlap by
    WIDTH - STRIDE; each window scores the STRIDE tokens after its last
    inputs, so each token is scored once, with 17 to 32 tokens before it
    (fewer only at the start of the text).  ``table``: ``entries``, if made before.
    """
    p = unpack(flat, vectors.shape[1], classes)
    out = np.zeros(len(tokens), np.float32)
    targets = np.maximum(lengths - 1, 0)
    windows = -(-targets // STRIDE)
    total = int(windows.sum())
    if total == 0:
        return out
    if table is None:
        table = entries(flat, vectors, classes)
    late = WIDTH - STRIDE
    ahead = late // STRIDE  # a window's earlier inputs are the scoring inputs of the windows before it
    begins = np.cumsum(lengths) - lengths
    number = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
    place = (np.repeat(begins, windows) + number * STRIDE)[:, None] + np.arange(STRIDE)  # of the scoring inputs
    used = place < np.repeat(begins + targets, windows)[:, None]  # a text's last window scores less
    np.minimum(place, len(tokens) - 2, out=place)
    inputs = np.concatenate([np.full((ahead, STRIDE), tokens[0]), tokens[place]])
    goals = classes_of.astype(np.int32)[tokens[1:][place]]
    del place
    value = np.empty((total, STRIDE), np.float32)
    bias = np.exp(p["bias"][_DISTANCE][WIDTH - STRIDE:]).astype(np.float32)
    bias[_FUTURE[WIDTH - STRIDE:]] = 0
    w1 = np.concatenate([p["b1"][None], p["w1"]]).T
    wc = _class_weights(p)
    with np.errstate(over="ignore", invalid="ignore"):  # found by _in_range
        for at in range(0, total, step):
            sl = slice(at, min(at + step, total))
            n = sl.stop - at
            state = table.take(inputs[at: sl.stop + ahead].ravel(), axis=0)
            row, item = state.strides
            seen = np.ndarray((n, WIDTH, state.shape[1]), state.dtype, state, strides=(STRIDE * row, row, item))
            q, k, v = seen[:, late:, D: D + HEAD], seen[:, :, D + HEAD: D + 2 * HEAD], seen[:, :, D + 2 * HEAD:]
            early = number[sl]
            early = early if early.min() < ahead else None
            mixed = np.empty((D + 1, n * STRIDE), np.float32)  # from here on a row per feature, places side by side
            for clip in (False, True):
                s = _weights(q @ k.transpose(0, 2, 1), bias, None, clip)
                for j in range(ahead if early is not None else 0):  # windows with less than that before them in their text
                    s[early < ahead - j, :, j * STRIDE: (j + 1) * STRIDE] = 0
                np.matmul(v.transpose(0, 2, 1), s.transpose(0, 2, 1),
                          out=mixed.reshape(D + 1, n, STRIDE).transpose(1, 0, 2))
                if _in_range(mixed[D]):
                    break
            f = np.empty((1 + D + HIDDEN, n * STRIDE), np.float32)  # a 1, whose weights are the biases, state, hidden
            h, z = f[: 1 + D], f[1 + D:]
            f[0] = 1
            np.multiply(mixed[:D], 1 / mixed[D], out=h[1:])
            h[1:] += state[late:, :D].T
            np.matmul(w1, h, out=z)
            np.maximum(z, 0, out=z)
            own = goals[sl].ravel() * z.shape[1] + np.arange(z.shape[1])
            for shift in (False, True):
                logit = wc @ f
                if shift:
                    logit -= logit.max(axis=0)
                picked = logit.ravel().take(own)
                np.exp(logit, out=logit)
                sums = logit.sum(axis=0)
                if _in_range(sums):
                    break
            np.subtract(picked, np.log(sums), out=value[sl].reshape(-1))
    marks = np.zeros(len(tokens), bool)
    marks[begins[lengths > 0]] = True
    out[~marks] = value[used]
    return out
