"""A bidirectional gated recurrent network with attention pooling, in numpy."""

from dataclasses import dataclass, field

import numpy as np

HIDDEN = 8


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Weights by name; ``f`` and ``b`` are the two directions. Inputs are projected first, then run through the cells."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(inputs: int, seed: int, hidden: int = HIDDEN, dtype=np.float32) -> "Network":
        draw = np.random.default_rng(seed)
        shapes = {"W": (inputs, 3 * hidden), "c": (3 * hidden,), "U": (hidden, 2 * hidden), "V": (hidden, hidden)}
        weights = {
            name + way: (draw.normal(size=shape) / np.sqrt(shape[0])).astype(dtype) if len(shape) == 2 else np.zeros(shape, dtype)
            for way in "fb"
            for name, shape in shapes.items()
        }
        weights["A"] = (draw.normal(size=(2 * hidden, hidden)) / np.sqrt(2 * hidden)).astype(dtype)
        weights["a"] = np.zeros(hidden, dtype)
        weights["v"] = (draw.normal(size=hidden) / np.sqrt(hidden)).astype(dtype)
        weights["o"] = (draw.normal(size=2 * hidden) / np.sqrt(2 * hidden)).astype(dtype)
        weights["p"] = np.full(1, -1.0, dtype)
        return Network(weights)

    def projected(self, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each input adds to the gates of the two directions, the same at every place."""
        w = self.weights
        return inputs @ w["Wf"] + w["cf"], inputs @ w["Wb"] + w["cb"]

    def _run(self, way: str, steps, gates, mask: np.ndarray, trace: list | None) -> np.ndarray:
        u, v = self.weights["U" + way], self.weights["V" + way]
        hidden = v.shape[0]
        h = np.zeros((mask.shape[0], hidden), dtype=v.dtype)
        out = np.empty((mask.shape[1], mask.shape[0], hidden), dtype=v.dtype)
        for t in steps:
            p, m = gates(t), mask[:, t, None]
            zr = sigmoid(p[:, : 2 * hidden] + h @ u)
            z, r = zr[:, :hidden], zr[:, hidden:]
            c = np.tanh(p[:, 2 * hidden :] + (r * h) @ v)
            new = h + m * z * (c - h)
            if trace is not None:
                trace.append((t, h, z, r, c, m))
            out[t] = h = new
        return out

    def forward(self, gates_f, gates_b, mask: np.ndarray, traced: bool = False):
        """Logits of windows. ``gates_f(t)`` and ``gates_b(t)`` give the projections at place t; ``mask`` is 1 where a word is."""
        w, length = self.weights, mask.shape[1]
        traces = ([], []) if traced else (None, None)
        h = np.concatenate(
            [
                self._run("f", range(length), gates_f, mask, traces[0]),
                self._run("b", range(length - 1, -1, -1), gates_b, mask, traces[1]),
            ],
            axis=2,
        )
        u = np.tanh(h @ w["A"] + w["a"])
        score = np.where(mask.T > 0, u @ w["v"], -1e9)
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        context = np.einsum("tn,tnh->nh", weight, h)
        logit = context @ w["o"] + w["p"][0]
        return (logit, (h, u, weight, context, traces)) if traced else logit

    def gradients(self, inputs: np.ndarray, mask: np.ndarray, truth: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """Mean cross-entropy of windows (n, length, inputs), its gradients by weight, and by input."""
        w = self.weights
        pf, pb = self.projected(inputs)
        logit, (h, u, weight, context, traces) = self.forward(lambda t: pf[:, t], lambda t: pb[:, t], mask, True)
        chance = sigmoid(logit)
        loss = float(-np.mean(truth * np.log(chance + 1e-9) + (1 - truth) * np.log(1 - chance + 1e-9)))
        d_logit = ((chance - truth) / len(truth)).astype(h.dtype)
        grad = {"p": np.array([d_logit.sum()]), "o": context.T @ d_logit}
        d_context = d_logit[:, None] * w["o"]
        d_weight = np.einsum("nh,tnh->tn", d_context, h)
        d_h = weight[:, :, None] * d_context[None]
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grad["v"] = np.einsum("tn,tna->a", d_score, u)
        d_u = d_score[:, :, None] * w["v"] * (1 - u * u)
        grad["A"], grad["a"] = np.einsum("tnh,tna->ha", h, d_u), d_u.sum(axis=(0, 1))
        d_h = d_h + d_u @ w["A"].T
        hidden, d_inputs = w["Vf"].shape[0], 0.0
        for k, way in enumerate("fb"):
            d_p = np.empty_like(pf)
            carry = np.zeros((len(truth), hidden), dtype=h.dtype)
            uu, vv = w["U" + way], w["V" + way]
            d_u2, d_v = np.zeros_like(uu), np.zeros_like(vv)
            for t, before, z, r, c, m in reversed(traces[k]):
                total = carry + d_h[t, :, k * hidden : (k + 1) * hidden]
                moved = total * m
                d_c = moved * z * (1 - c * c)
                d_rh = d_c @ vv.T
                d_zr = np.concatenate([moved * (c - before) * z * (1 - z), d_rh * before * r * (1 - r)], axis=1)
                carry = total - moved * z + d_rh * r + d_zr @ uu.T
                d_v += (r * before).T @ d_c
                d_u2 += before.T @ d_zr
                d_p[:, t] = np.concatenate([d_zr, d_c], axis=1)
            flat = d_p.reshape(-1, d_p.shape[2])
            grad["U" + way], grad["V" + way] = d_u2, d_v
            grad["W" + way], grad["c" + way] = inputs.reshape(-1, inputs.shape[2]).T @ flat, flat.sum(axis=0)
            d_inputs = d_inputs + d_p @ w["W" + way].T
        return loss, grad, d_inputs


class Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.first, self.second = rate, 0, {}, {}

    def update(self, weights: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        for name, g in grads.items():
            m = self.first[name] = 0.9 * self.first.get(name, 0) + 0.1 * g
            v = self.second[name] = 0.999 * self.second.get(name, 0) + 0.001 * g * g
            scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
            weights[name] = (weights[name] - scale * m / (np.sqrt(v) + 1e-8)).astype(weights[name].dtype)
