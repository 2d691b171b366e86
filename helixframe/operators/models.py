"""Statistical models of coverage: a mixture of ploidies fitted to a histogram, and a hidden Markov model along contigs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mixture_densities(x: np.ndarray, rate: float, most: float, mean: float, variance: float, ploidies: int) -> np.ndarray:
    """(values, 1 + ploidies): a truncated exponential of errors, and normals of p times the haploid mean and variance."""
    error = np.where((x >= 0) & (x <= most), rate * np.exp(-rate * x) / -np.expm1(-rate * most), 0.0)
    p = np.arange(1, ploidies + 1)
    z = (x[:, None] - p * mean) ** 2 / (2 * p * variance)
    return np.column_stack([error, np.exp(-z) / np.sqrt(2 * np.pi * p * variance)])


def _best_rate(mean: float, most: float) -> float:
    """The rate of a truncated exponential of that mean, by golden-section search of its likelihood."""
    value = lambda r: np.log(r) - np.log(-np.expm1(-r * most)) - r * mean
    low, high, ratio = 1e-9, 50.0, (5**0.5 - 1) / 2
    for _ in range(200):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if value(a) > value(b) else (a, high)
    return (low + high) / 2


def fit_mixture(values: np.ndarray, counts: np.ndarray, ploidies: int = 4, tolerance: float = 1e-8, rounds: int = 2000) -> dict:
    """Expectation maximisation on a histogram; raises if it does not converge. The start is the highest count past the first valley."""
    x, n = values.astype(float), counts.astype(float)
    order = np.argsort(x)
    x, n = x[order], n[order]
    valley = next((i for i in range(1, len(n) - 1) if n[i] <= n[i - 1] and n[i] < n[i + 1]), 0)
    mean = max(float(x[valley + int(np.argmax(n[valley:]))]), 1.0)
    variance, rate, most = mean, 1.0, mean
    weights = np.full(ploidies + 1, 1 / (ploidies + 1))
    p = np.arange(1, ploidies + 1)
    before = -np.inf
    for _ in range(rounds):
        joint = mixture_densities(x, rate, most, mean, variance, ploidies) * weights
        total = np.maximum(joint.sum(axis=1), 1e-300)
        likelihood = float((n * np.log(total)).sum())
        share = joint / total[:, None] * n[:, None]
        weights = share.sum(axis=0) / n.sum()
        mean = float((share[:, 1:] * x[:, None]).sum() / (share[:, 1:] * p).sum())
        variance = max(float((share[:, 1:] * (x[:, None] - p * mean) ** 2 / p).sum() / share[:, 1:].sum()), 1e-6)
        if share[:, 0].sum() > 0:
            rate = _best_rate(float((share[:, 0] * x).sum() / share[:, 0].sum()), most)
        if abs(likelihood - before) <= tolerance * abs(likelihood):
            return {"mean": mean, "variance": variance, "rate": rate, "weights": weights, "most": most, "likelihood": likelihood}
        before = likelihood
    raise ValueError("the mixture has not converged")


def fit_windows(histogram: DataFrame, key: str, ploidies: int = 4) -> DataFrame:
    """(key, mean, variance, rate, weight_0 .. weight_p): one fit per window of a histogram (key, coverage, freq). A window's distinct coverages fit in a task."""
    names = [f"weight_{i}" for i in range(ploidies + 1)]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        f = fit_mixture(pdf.coverage.to_numpy(), pdf.freq.to_numpy(), ploidies)
        return pd.DataFrame([{key: pdf[key].iloc[0], "mean": f["mean"], "variance": f["variance"], "rate": f["rate"], **dict(zip(names, f["weights"], strict=True))}])

    kind = histogram.schema[key].dataType.simpleString()
    return histogram.groupBy(key).applyInPandas(one, f"`{key}` {kind}, mean double, variance double, rate double, " + ", ".join(f"{n} double" for n in names))


def forward_backward(emissions: np.ndarray, transition: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Posteriors (positions, states), expected transitions (states, states) and log likelihood, by the recursions scaled at each position."""
    n, k = emissions.shape
    forward, scale = np.zeros((n, k)), np.zeros(n)
    now = start * emissions[0]
    for i in range(n):
        if i:
            now = (forward[i - 1] @ transition) * emissions[i]
        scale[i] = max(now.sum(), 1e-300)
        forward[i] = now / scale[i]
    backward, moves = np.ones((n, k)), np.zeros((k, k))
    for i in range(n - 2, -1, -1):
        after = emissions[i + 1] * backward[i + 1] / scale[i + 1]
        backward[i] = transition @ after
        moves += forward[i][:, None] * transition * after
    return forward * backward, moves, float(np.log(scale).sum())


def _emissions(x: np.ndarray, means: np.ndarray, variances: np.ndarray) -> np.ndarray:
    return np.maximum(np.exp(-((x[:, None] - means) ** 2) / (2 * variances)) / np.sqrt(2 * np.pi * variances), 1e-300)


def hmm_labels(df: DataFrame, model: dict, chunk: str = "chunk") -> DataFrame:
    """(chunk, pos, state, probability): the likeliest state of each position of (chunk, pos, depth). Chunks are of bounded length and independent."""
    means, variances, transition, start = (np.array(model[k], float) for k in ("means", "variances", "transition", "start"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        posterior, _, _ = forward_backward(_emissions(pdf.depth.to_numpy(float), means, variances), transition, start)
        best = posterior.argmax(axis=1)
        return pd.DataFrame({chunk: pdf[chunk], "pos": pdf.pos, "state": best, "probability": np.round(posterior[np.arange(len(best)), best], 9)})

    kind = df.schema[chunk].dataType.simpleString()
    return df.select(chunk, "pos", "depth").groupBy(chunk).applyInPandas(one, f"`{chunk}` {kind}, pos long, state long, probability double")


def _statistics(means: np.ndarray, variances: np.ndarray, transition: np.ndarray, start: np.ndarray):
    """A function from a chunk to its sufficient statistics, one row per state."""

    def stats(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("pos").depth.to_numpy(float)
        posterior, moves, likelihood = forward_backward(_emissions(x, means, variances), transition, start)
        rows = {"state": np.arange(len(means)), "n": posterior.sum(axis=0), "x": posterior.T @ x, "xx": posterior.T @ (x * x), "first": posterior[0], "likelihood": np.full(len(means), likelihood)}
        return pd.DataFrame(rows | {f"to_{j}": moves[:, j] for j in range(len(means))})

    return stats


def hmm_train(df: DataFrame, model: dict, rounds: int, chunk: str = "chunk") -> dict:
    """The model after so many rounds of expectation maximisation: sufficient statistics per chunk, summed by Spark, one small row per state to the driver."""
    for _ in range(rounds):
        means, variances, transition, start = (np.array(model[k], float) for k in ("means", "variances", "transition", "start"))
        k = len(means)

        schema = "state long, n double, x double, xx double, first double, likelihood double, " + ", ".join(f"to_{j} double" for j in range(k))
        sums = df.select(chunk, "pos", "depth").groupBy(chunk).applyInPandas(_statistics(means, variances, transition, start), schema)
        t = sums.groupBy("state").agg(*[F.sum(c).alias(c) for c in sums.columns[1:]]).toPandas().sort_values("state")
        n = np.maximum(t.n.to_numpy(), 1e-12)
        mean = t.x.to_numpy() / n
        moves = t[[f"to_{j}" for j in range(k)]].to_numpy() + 1e-12
        model = {"means": mean, "variances": np.maximum(t.xx.to_numpy() / n - mean**2, 1e-3), "transition": moves / moves.sum(axis=1, keepdims=True), "start": t["first"].to_numpy() / t["first"].sum(), "likelihood": float(t.likelihood.iloc[0])}
    return model


def _growing_sums(x: np.ndarray, terms) -> np.ndarray:
    """For each whole number of x, the sum of terms(0 .. x - 1)."""
    return np.concatenate([[0.0], np.cumsum(terms(np.arange(int(x.max()), dtype=float)))])[x]


def _negative_binomials(x: np.ndarray, sizes: np.ndarray, thetas: np.ndarray) -> np.ndarray:
    """(values, components): log probabilities of sizes r and success probabilities theta."""
    return np.column_stack([_growing_sums(x, lambda i, r=r: np.log((r + i) / (i + 1))) + r * np.log(t) + x * np.log1p(-t) for r, t in zip(sizes, thetas, strict=True)])


def fit_negative_binomials(values: np.ndarray, counts: np.ndarray, ploidies: int = 4, tolerance: float = 1e-9, rounds: int = 2000) -> dict:
    """A mixture of negative binomials, fitted to a histogram: one of errors, and one per ploidy with so many times the haploid mean and variance.

    Expectation maximisation on the compound form (a Poisson number of logarithmic clusters), each two steps of which are
    extrapolated by SQUAREM; an extrapolation that lowers the likelihood is halved towards the plain steps, so that none is lost.
    Raises if it does not converge. likelihood, aic and bic are given beside the parameters.
    """
    order = np.argsort(values)
    x, n = np.asarray(values, np.int64)[order], np.asarray(counts, float)[order]
    p = np.arange(1, ploidies + 1)
    valley = next((i for i in range(1, len(n) - 1) if n[i] <= n[i - 1] and n[i] < n[i + 1]), 0)
    peak = max(float(x[valley + int(np.argmax(n[valley:]))]), 1.0)

    def unpacked(u: np.ndarray):
        """Sizes, success probabilities and weights of a point: log rate and logit of errors, of a ploidy, log weights."""
        theta = np.clip(1 / (1 + np.exp(-np.clip(u[[1, 3]], -30, 30))), 1e-10, 1 - 1e-10)
        size = np.exp(np.clip(u[[0, 2]], -30, 30)) / -np.log(theta)
        w = np.exp(u[4:] - u[4:].max())
        return np.concatenate([[size[0]], size[1] * p]), np.concatenate([[theta[0]], np.full(ploidies, theta[1])]), w / w.sum()

    def joint(u: np.ndarray):
        sizes, thetas, w = unpacked(u)
        logs = _negative_binomials(x, sizes, thetas) + np.log(np.maximum(w, 1e-300))
        top = logs.max(axis=1)
        total = top + np.log(np.exp(logs - top[:, None]).sum(axis=1))
        return logs, total, float((n * total).sum())

    def step(u: np.ndarray) -> np.ndarray:
        sizes, thetas, _ = unpacked(u)
        logs, total, _ = joint(u)
        share = np.exp(logs - total[:, None]) * n[:, None]
        # Expected clusters of a value: r / r + r / (r + 1) + ... up to it.
        clusters = np.column_stack([_growing_sums(x, lambda i, r=r: r / (r + i)) for r in sizes])
        out = u.copy()
        for part, at, copies in (([0], 0, np.ones(1)), (slice(1, None), 2, p)):
            s, d, theta = share[:, part], clusters[:, part], thetas[part][0]
            made = float((s * d).sum())
            if s.sum() <= 1e-6 * n.sum() or made <= 0:
                continue
            beta = -theta / (1 - theta) - 1 / np.log(theta)
            fresh = float(np.clip(beta * made / (s * (x[:, None] + d * (beta - 1))).sum(), 1e-10, 1 - 1e-10))
            out[at] = np.log(made / float((s * copies).sum()))
            out[at + 1] = np.log(fresh) - np.log1p(-fresh)
        out[4:] = np.log(np.maximum(share.sum(axis=0) / n.sum(), 1e-12))
        return out

    theta = 0.5
    u = np.concatenate([[np.log(max(peak / 20, 0.05) * -np.log(theta)), 0.0, np.log(peak * theta / (1 - theta) * -np.log(theta)), 0.0], np.full(ploidies + 1, -np.log(ploidies + 1))])
    before = joint(u)[2]
    for _ in range(rounds):
        one = step(u)
        two = step(one)
        r, v = one - u, two - 2 * one + u
        far = -float(np.linalg.norm(r) / max(np.linalg.norm(v), 1e-12))
        reached = joint(two)[2]
        while far < -1 - 1e-3:
            ahead = u - 2 * far * r + far * far * v
            if joint(ahead)[2] >= reached:
                two = ahead
                break
            far = (far - 1) / 2
        u = step(two)
        now = joint(u)[2]
        if abs(now - before) <= tolerance * abs(now):
            sizes, thetas, w = unpacked(u)
            mean, k = sizes[1] * (1 - thetas[1]) / thetas[1], 4 + ploidies
            return {"mean": float(mean), "variance": float(mean / thetas[1]), "error_mean": float(sizes[0] * (1 - thetas[0]) / thetas[0]), "weights": w, "likelihood": now, "aic": 2 * k - 2 * now, "bic": k * float(np.log(n.sum())) - 2 * now}
        before = now
    raise ValueError("the mixture has not converged")


def fit_negative_binomial_windows(histogram: DataFrame, key: str, ploidies: int = 4) -> DataFrame:
    """(key, mean, variance, error_mean, aic, bic, weight_0 .. weight_p): one fit per window of a histogram (key, coverage, freq). A window's distinct coverages fit in a task."""
    names = [f"weight_{i}" for i in range(ploidies + 1)]
    single = ["mean", "variance", "error_mean", "aic", "bic"]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        f = fit_negative_binomials(pdf.coverage.to_numpy(), pdf.freq.to_numpy(), ploidies)
        return pd.DataFrame([{key: pdf[key].iloc[0], **{s: f[s] for s in single}, **dict(zip(names, f["weights"], strict=True))}])

    kind = histogram.schema[key].dataType.simpleString()
    return histogram.groupBy(key).applyInPandas(one, f"`{key}` {kind}, " + ", ".join(f"{c} double" for c in single + names))
