"""The lattice recursion over one very long word, in blocks and with bounded memory.

A piece reaches back over at most ``longest`` bytes, so the forward recursion
is a linear map of the last ``longest`` prefix probabilities.  The word is cut
into blocks of positions; the maps of many blocks are built side by side (a
matrix of ``longest`` x ``longest`` each), and the blocks are then chained by
one product each.  All numbers are scaled, their logarithms kept apart, so this
is the recursion in log space at the cost of one in plain numbers.

A part of :data:`SIDE` blocks is worked on at a time.  What grows with the word
is one matrix a block (about 10 bytes a byte of the word), and its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

STEPS = 512  # positions in a block
SIDE = 64  # blocks side by side
RESCALE = 8  # steps between scalings; a step loses 15 decimal digits at most


def arcs_between(symbols: np.ndarray, low: int, high: int, pieces) -> np.ndarray:
    """(high - low, longest): number of the piece that ends with byte ``low + i`` and has a length, or -1."""
    most = pieces.longest
    begin = max(0, low - most + 1)
    own = symbols[begin:high]
    out = np.full((high - low, most), -1, np.int32)
    h = np.zeros(len(own) + 1, np.uint64)
    for size in range(1, most + 1):
        h = h[:-1] * pieces.base + own[size - 1 :]  # h[i]: the substring of this size that ends at begin + size - 1 + i
        if len(h) == 0:
            break
        skip = max(0, low - (begin + size - 1))
        ends = h[skip:]
        out[high - low - len(ends) :, size - 1] = pieces.find(ends)
    return out


class LongWord:
    """A word as bytes, word mark included, under one distribution of pieces."""

    def __init__(self, data: np.ndarray, pieces, log_p: np.ndarray) -> None:
        self.symbols = pieces.symbols[data]
        self.pieces = pieces
        self.log_p = np.append(log_p, -np.inf)

    def _parts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(arcs, probabilities), each (blocks, steps, longest), front to back; the last block has a part of its own."""
        n, width = len(self.symbols), STEPS * SIDE
        for low in range(0, n, width):
            high = min(low + width, n)
            arcs = arcs_between(self.symbols, low, high, self.pieces)
            whole = (high - low) // STEPS * STEPS
            for piece in (arcs[:whole], arcs[whole:]):
                if len(piece):
                    shaped = piece.reshape(-1, min(STEPS, len(piece)), self.pieces.longest)
                    yield shaped, np.exp(self.log_p[shaped])

    def _chain(self, keep: list | None = None) -> tuple[np.ndarray, float]:
        """State after the last byte and its log scale; ``keep`` receives (matrix, state before, scale before) by block."""
        state, scale = np.zeros(self.pieces.longest), 0.0
        state[0] = 1.0
        for _, p in self._parts():
            for matrix, log_scale in zip(*block_maps(p)):
                if keep is not None:
                    keep.append((matrix, state, scale))
                state = matrix @ state
                top = state.max()
                state, scale = state / top, scale + float(log_scale) + float(np.log(top))
        return state, scale

    def log_probability(self) -> float:
        """Natural log of the sum over all segmentations."""
        state, scale = self._chain()
        return float(np.log(state[0])) + scale

    def expected_counts(self, counts: np.ndarray, times: float) -> float:
        """Add the expected number of every piece, ``times`` over, to ``counts``; returns the log probability."""
        blocks: list = []
        last, scale = self._chain(blocks)
        total = float(np.log(last[0])) + scale
        behind: list = []  # by block, from the last: (adjoint of the state after it, log scale)
        after, after_scale = np.zeros(self.pieces.longest), 0.0
        after[0] = 1.0
        for matrix, state, before in reversed(blocks):
            behind.append((after, after_scale))
            after = matrix.T @ after
            top = after.max()
            # A map's own scale: what the adjoint lacks to give the same total with the state before the block.
            after = after / top
            after_scale = total - before - float(np.log(after @ state))
        behind.reverse()
        at = 0
        for arcs, p in self._parts():
            own, end = blocks[at : at + len(p)], behind[at : at + len(p)]
            at += len(p)
            starts = np.stack([b[1] for b in own]), np.array([b[2] for b in own])
            ends = np.stack([e[0] for e in end]), np.array([e[1] for e in end])
            share = _arc_shares(p, *starts, *ends, total)
            held = arcs >= 0
            counts += np.bincount(arcs[held], share[held] * times, len(counts))[: len(counts)]
        return total


def block_maps(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(blocks, longest, longest) scaled maps of the state over each block, and their log scales."""
    blocks, steps, most = p.shape
    held = np.broadcast_to(np.eye(most), (blocks, most, most)).copy()  # slot (head + k) % most: k positions back
    scale, head = np.zeros(blocks), 0
    for i in range(steps):
        turned = np.roll(p[:, i], head, axis=1)[:, None, :]
        head = (head - 1) % most
        held[:, head] = (turned @ held)[:, 0]
        if i % RESCALE == RESCALE - 1:
            top = held.max(axis=(1, 2))
            held /= top[:, None, None]
            scale += np.log(top)
    top = held.max(axis=(1, 2))
    return np.roll(held, -head, axis=1) / top[:, None, None], scale + np.log(top)


def _arc_shares(p: np.ndarray, state: np.ndarray, scale: np.ndarray, after: np.ndarray, after_scale: np.ndarray, total: float) -> np.ndarray:
    """Posterior probability of every arc of the blocks, from the states before and the adjoints after them."""
    blocks, steps, most = p.shape
    alpha = np.empty((steps + most, blocks))
    alpha[:most] = state.T[::-1]
    logs = np.broadcast_to(scale, alpha.shape).copy()
    for i in range(steps):
        t = most + i
        alpha[t] = (p[:, i] * alpha[i:t][::-1].T).sum(axis=1)
        logs[t] = logs[t - 1]
        if i % RESCALE == RESCALE - 1:
            top = alpha[t - most + 1 : t + 1].max(axis=0)
            alpha[t - most + 1 : t + 1] /= top
            logs[t - most + 1 : t + 1] += np.log(top)
    with np.errstate(divide="ignore"):
        log_alpha = np.log(alpha) + logs
        log_p = np.log(p)
    out = np.zeros(p.shape)
    back, back_scale = after.copy(), after_scale.copy()
    for i in range(steps - 1, -1, -1):
        t = most + i
        beta = back[:, :1]
        with np.errstate(divide="ignore"):
            log_beta = np.log(beta) + back_scale[:, None]
        out[:, i] = np.exp(log_alpha[i:t][::-1].T + log_p[:, i] + log_beta - total)
        back = p[:, i] * beta + np.concatenate([back[:, 1:], np.zeros((blocks, 1))], axis=1)
        if i % RESCALE == 0:
            top = back.max(axis=1)
            back /= top[:, None]
            back_scale = back_scale + np.log(top)
    return out
