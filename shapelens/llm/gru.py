"""A gated recurrent layer in numpy, with backpropagation through time and Adam."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place on a fresh array."""
    np.negative(x, out=x)
    np.exp(np.minimum(x, np.float32(30), out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Gru:
    """Symbols in, states out: z, r = sigmoid(W[x] + h U), c = tanh(W[x] + (r h) Uc), h = c + z (h - c)."""

    def __init__(self, symbols: int, size: int, random: np.random.Generator):
        self.size = size
        self.p = {
            "w": random.normal(0, 0.1, (symbols, 3 * size)).astype(np.float32),
            "u": (random.normal(0, 1, (size, 2 * size)) / np.sqrt(size)).astype(np.float32),
            "uc": (random.normal(0, 1, (size, size)) / np.sqrt(size)).astype(np.float32),
        }

    def step(self, symbols: np.ndarray, h: np.ndarray) -> np.ndarray:
        n = 2 * self.size
        given = self.p["w"][symbols]
        zr = h @ self.p["u"]
        zr += given[:, :n]
        zr = sigmoid(zr)
        c = (zr[:, self.size:] * h) @ self.p["uc"]
        c += given[:, n:]
        np.tanh(c, out=c)
        out = h - c
        out *= zr[:, : self.size]
        out += c
        return out

    def forward(self, symbols: np.ndarray, h: np.ndarray, real: np.ndarray):
        """symbols and real (whether there is a symbol) have a row per step. Returns the states and what `backward` needs."""
        n, out, kept = 2 * self.size, np.empty((*symbols.shape, self.size), np.float32), []
        for t in range(len(symbols)):
            given = self.p["w"][symbols[t]]
            zr = sigmoid(h @ self.p["u"] + given[:, :n])
            z, r = zr[:, : self.size], zr[:, self.size:]
            c = np.tanh((r * h) @ self.p["uc"] + given[:, n:])
            kept.append((h, z, r, c))
            h = np.where(real[t][:, None], c + z * (h - c), h)
            out[t] = h
        return out, kept

    def backward(self, symbols: np.ndarray, real: np.ndarray, kept: list, d_out: np.ndarray) -> dict[str, np.ndarray]:
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d_in = np.empty((*symbols.shape, 3 * self.size), np.float32)
        dh = np.zeros_like(d_out[0])
        for t in range(len(symbols) - 1, -1, -1):
            h, z, r, c = kept[t]
            dh = dh + d_out[t]
            here = real[t][:, None]
            passed, dh = np.where(here, 0, dh), np.where(here, dh, 0)
            dc = dh * (1 - z) * (1 - c * c)
            drh = dc @ self.p["uc"].T
            dzr = np.concatenate([dh * (h - c) * z * (1 - z), drh * h * r * (1 - r)], 1)
            g["u"] += h.T @ dzr
            g["uc"] += (r * h).T @ dc
            d_in[t, :, : 2 * self.size], d_in[t, :, 2 * self.size:] = dzr, dc
            dh = passed + dh * z + drh * r + dzr @ self.p["u"].T
        flat, d_flat = symbols.ravel(), d_in.reshape(-1, 3 * self.size)
        order = np.argsort(flat, kind="stable")
        seen, at = np.unique(flat[order], return_index=True)
        g["w"][seen] = np.add.reduceat(d_flat[order], at, axis=0)
        return g

    def forward_all(self, symbols: np.ndarray, h: np.ndarray):
        """`forward` where every stream has a symbol at every step; `backward_all` takes what is kept.

        Working arrays have a column per stream, so that gates are contiguous.
        """
        n = self.size
        u, uc = -self.p["u"].T, self.p["uc"].T.copy()
        given = np.ascontiguousarray(self.p["w"][symbols].transpose(0, 2, 1))
        np.negative(given[:, : 2 * n], out=given[:, : 2 * n])
        hs = np.empty((len(symbols) + 1, n, symbols.shape[1]), np.float32)
        hs[0] = h.T
        cs, rhs = np.empty_like(hs[1:]), np.empty_like(hs[1:])
        with np.errstate(over="ignore"):  # a closed gate is 1 / inf
            for t in range(len(symbols)):
                zr, c, h = given[t, : 2 * n], cs[t], hs[t]
                zr += u @ h
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                np.multiply(zr[n:], h, out=rhs[t])
                np.matmul(uc, rhs[t], out=c)
                c += given[t, 2 * n:]
                np.tanh(c, out=c)
                np.subtract(h, c, out=hs[t + 1])
                hs[t + 1] *= zr[:n]
                hs[t + 1] += c
        return hs[1:].transpose(0, 2, 1).copy(), (hs[:-1], given[:, :n], given[:, n: 2 * n], cs, rhs)

    def backward_all(self, symbols: np.ndarray, kept: tuple, d_out: np.ndarray) -> dict[str, np.ndarray]:
        n, (hs, zs, rs, cs, rhs) = self.size, kept
        by_c, by_z, by_r = (1 - zs) * (1 - cs * cs), (hs - cs) * zs * (1 - zs), rhs * (1 - rs)
        d_out = np.ascontiguousarray(d_out.transpose(0, 2, 1))
        d_in = np.empty((len(symbols), 3 * n, symbols.shape[1]), np.float32)
        dh = np.zeros_like(d_out[0])
        for t in range(len(symbols) - 1, -1, -1):
            dh += d_out[t]
            dzr, dc = d_in[t, : 2 * n], d_in[t, 2 * n:]
            np.multiply(dh, by_c[t], out=dc)
            drh = self.p["uc"] @ dc
            np.multiply(dh, by_z[t], out=dzr[:n])
            np.multiply(drh, by_r[t], out=dzr[n:])
            dh *= zs[t]
            drh *= rs[t]
            dh += drh
            dh += self.p["u"] @ dzr
        g = {"w": np.zeros_like(self.p["w"]), "u": (hs @ d_in[:, : 2 * n].transpose(0, 2, 1)).sum(0), "uc": (rhs @ d_in[:, 2 * n:].transpose(0, 2, 1)).sum(0)}
        flat, d_flat = symbols.ravel(), d_in.transpose(0, 2, 1).reshape(-1, 3 * n)
        order = np.argsort(flat, kind="stable")
        seen, at = np.unique(flat[order], return_index=True)
        g["w"][seen] = np.add.reduceat(d_flat[order], at, axis=0)
        return g


class Adam:
    def __init__(self, rate: float = 0.01):
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def __call__(self, params: dict[str, np.ndarray], grads: dict[str, np.ndarray], clip: float = 5.0) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = min(1.0, clip / (norm + 1e-9))
        for k, g in grads.items():
            g = g * np.float32(scale)
            self.m[k] = 0.9 * self.m.get(k, 0) + 0.1 * g
            self.v[k] = 0.999 * self.v.get(k, 0) + 0.001 * g * g
            params[k] -= (self.rate * self.m[k] / (1 - 0.9**self.t) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)
