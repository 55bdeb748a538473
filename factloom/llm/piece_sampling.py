"""SentencePiece encoding and decoding with Gumbel top-k sampling without replacement.

Every way of spelling a text with the vocabulary's pieces is a path through its
lattice. Piece probabilities follow a Zipf-Mandelbrot law over the pieces' ranks
(the public model ranks merges and has no probabilities), p ~ 1 / (rank + SHIFT), raised to the power alpha (the
inverse temperature of sampling). The sampler draws, for each row, the k paths with the largest
Gumbel-perturbed log-probabilities, which is a sample of k distinct
segmentations without replacement, each with its log inclusion probability
given the (k+1)-th perturbed value.

The search is A-star over regions of paths. A text falls into units that no
piece crosses (runs of blanks with the word after them; line ends), so that a
path is a choice for each unit. A region is "these choices up to unit i, another
one at i"; its bound, the largest perturbed value within it, is a Gumbel of its
total probability, truncated at its parent's. The best region is split: its
best path is drawn by ancestral sampling from the backward sums of the lattice,
what is left of it and the branches off the new path become regions. All units
of a batch of rows are drawn together in numpy.

Draws are hashes of (seed, row key, sample, unit, step): a row's samples do not
depend on what is beside it, and equal keys and texts have equal samples.

Null and empty texts have one segmentation, the empty one, of probability 1; a
text with fewer than k segmentations gives all it has, with inclusion
probability 1. Characters outside the vocabulary become byte pieces, so that
decoding gives back the very text (a literal U+2581 comes back as a blank). An
empty table gives an empty table.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.shared import bounded_batches, give_back

SHIFT = 10.0
BATCH_CHARS = 600_000
HELD_NODES = 1_000_000
BLANK = "▁"
_UNIT = re.compile(r" +[^ \n]*|[^ \n]+|\n")
_DENSE = 256
_WORD = (1 << 64) - 1
_MODELS: dict[tuple[str, float], "Pieces"] = {}


def _mix(z: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser over uint64, in z's own place."""
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def _seeds(base: np.ndarray, number: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        step = np.asarray(number).astype(np.uint64)
        step *= np.uint64(0x9E3779B97F4A7C15)
        step += np.uint64(0x632BE59BD9B4E019)
        return _mix(np.asarray(base, np.uint64) + step)


def _uniform(z: np.ndarray) -> np.ndarray:
    u = (z >> np.uint64(11)).astype(np.float64)
    u += 0.5
    u *= 2.0**-53
    return u


def _seed(base: int, number: int) -> int:
    """_seeds() of one."""
    z = (base + number * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _WORD
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & _WORD
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _WORD
    return z ^ (z >> 31)


def _uniform_of(z: int) -> float:
    """_uniform() of one."""
    return ((z >> 11) + 0.5) * 2.0**-53


class Pieces:
    """The vocabulary as a trie with log-probabilities."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.bytes_of: list[bytes] = [b""] * size
        self.byte_id = np.zeros(256, np.int32)
        spelt: dict[str, int] = {}
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                spelt[piece.replace(BLANK, " ")] = i
                self.bytes_of[i] = piece.replace(BLANK, " ").encode()
        if any(re.search(r"[^ ] |\n", s) for s in spelt):
            raise ValueError("a piece crosses the units that the sampler takes to be independent")
        rank = np.array([size if sp.get_score(i) < -1e8 or sp.is_byte(i) else i for i in range(size)], np.float64)
        zipf = -np.log(rank + SHIFT)
        self.logp = alpha * (zipf - np.log(np.exp(zipf).sum()))
        self.byte_logp = float(self.logp[self.byte_id[0]])
        self.lowest = 4 * float(self.logp.min())  # of one character, spelt in bytes if need be
        self.bytes_array = np.array([*self.bytes_of, b""], dtype=object)[:-1]
        letters = sorted({c for s in spelt for c in s}, key=lambda c: spelt.get(c, size))
        self.code = np.full(0x110000, len(letters), np.int32)
        self.code[[ord(c) for c in letters]] = np.arange(len(letters))
        self.width = len(letters) + 1
        edges: dict[tuple[int, int], int] = {}
        ends = [-1]
        for s, i in spelt.items():
            state = 0
            for c in s:
                key = (state, int(self.code[ord(c)]))
                if key not in edges:
                    edges[key] = len(ends)
                    ends.append(-1)
                state = edges[key]
            ends[state] = i
        self.ends = np.array(ends, np.int32)
        inner = sorted({s for s, _ in edges})
        self.row = np.full(len(ends), len(inner), np.int32)
        self.row[inner] = np.arange(len(inner))
        self.dense = np.full((len(inner) + 1, _DENSE), -1, np.int32)
        rare = []
        for (s, c), t in edges.items():
            if c < _DENSE:
                self.dense[self.row[s], c] = t
            else:
                rare.append((s * self.width + c, t))
        rare.sort()
        self.rare_key = np.array([k for k, _ in rare] + [np.iinfo(np.int64).max], np.int64)
        self.rare_to = np.array([t for _, t in rare] + [-1], np.int32)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The states that the codes lead to (-1: none)."""
        common = code < _DENSE
        if common.all():
            return self.dense[self.row[state], code]
        out = np.full(len(state), -1, np.int32)
        out[common] = self.dense[self.row[state[common]], code[common]]
        key = state[~common].astype(np.int64) * self.width + code[~common]
        at = np.searchsorted(self.rare_key, key)
        out[~common] = np.where(self.rare_key[at] == key, self.rare_to[at], -1)
        return out


def load_pieces(path: str, alpha: float = 0.5) -> Pieces:
    """The model of a file, loaded once in each process."""
    if (path, alpha) not in _MODELS:
        _MODELS[path, alpha] = Pieces(path, alpha)
    return _MODELS[path, alpha]


class _Part:
    """The lattices of some units, numbered from 0."""

    def __init__(self, pieces: Pieces, units: list[str]):
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.cumsum(lengths)
        # nodes: each character's start, and one more for each unit's end
        self.start = ends - lengths + np.arange(len(units))
        node_of = np.arange(len(points)) + np.repeat(np.arange(len(units)), lengths)
        left = np.repeat(ends, lengths) - np.arange(len(points))  # characters from here to the unit's end
        code = pieces.code[points]
        single = np.zeros(len(points), bool)
        at, state, depth = np.arange(len(points), dtype=np.int32), np.zeros(len(points), np.int32), 0
        held = np.zeros(len(points), np.int32)  # edges found so far at each character, shortest first
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
        while len(at):
            state = pieces.step(state, code[at + depth])
            depth += 1
            alive = np.flatnonzero(state >= 0)
            at, state = at[alive], state[alive]
            ended = pieces.ends[state]
            ok = np.flatnonzero(ended >= 0)
            where = at[ok]
            found.append((where, held[where], ended[ok], depth))
            held[where] += 1
            if depth == 1:
                single = held > 0
            more = np.flatnonzero(left[at] > depth)
            at, state = at[more], state[more]
        strange = np.flatnonzero(~single) if found else np.zeros(0, np.int64)
        one_byte = points[strange] < 0x80
        spelt = np.where(one_byte, pieces.byte_id[np.minimum(points[strange], 0x7F)], -1 - points[strange])  # the others are spelt in bytes later
        found.append((strange, held[strange], spelt.astype(np.int32), 1))
        held[strange] += 1
        start_of = np.concatenate([[0], np.cumsum(held)])
        self.piece, size = np.empty(start_of[-1], np.int32), np.empty(start_of[-1], np.int32)
        for where, rank, piece, length in found:
            to = start_of[where] + rank
            self.piece[to], size[to] = piece, length
        src = np.repeat(np.arange(len(points), dtype=np.int32), held)
        logp = pieces.logp[np.maximum(self.piece, 0)]
        for e in np.flatnonzero(self.piece < 0).tolist():
            logp[e] = pieces.byte_logp * len(chr(-1 - int(self.piece[e])).encode("utf-8", "surrogatepass"))
        self.logp = logp
        self.src = node_of[src]
        self.dst = self.src + size
        nodes = len(points) + len(units)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.src, minlength=nodes))])
        # backward sums, from the units' ends to their starts
        self.beta = np.zeros(nodes)
        far = left[src]
        by_far = np.argsort(far.astype(np.uint16) if len(far) and far.max() < 1 << 16 else far, kind="stable")
        cuts = np.searchsorted(far[by_far], np.arange(1, int(far.max()) + 2)) if len(far) else []
        for distance, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False), 1):
            near = distance * pieces.lowest > -600
            if lo == hi:
                continue
            e = by_far[lo:hi]
            s = self.src[e]
            new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            value = logp[e] + self.beta[self.dst[e]]
            if near:  # sums of so few factors do not vanish
                self.beta[s[new]] = np.log(np.add.reduceat(np.exp(value), new))
                continue
            top = np.maximum.reduceat(value, new)
            total = np.add.reduceat(np.exp(value - np.repeat(top, np.diff(np.append(new, len(e))))), new)
            self.beta[s[new]] = top + np.log(total)
        self.q = np.exp(logp + self.beta[self.dst] - self.beta[self.src])
        running = np.cumsum(self.q)
        before = np.concatenate([[0.0], running])[self.first[:-1]]
        cum = running - before[self.src]
        has = self.first[1:] > self.first[:-1]
        cum[self.first[1:][has] - 1] = 1.0
        self.key = self.src + np.minimum(cum, 1.0)
        self.final = ~has
        # the likeliest edge of each node is tried before the search
        self.top = np.zeros(nodes, np.int64)
        self.top_q, self.top_from = np.zeros(nodes), np.zeros(nodes)
        if len(self.q):
            begins = self.first[:-1][has]
            most = np.maximum.reduceat(self.q, begins)
            is_top = np.flatnonzero(self.q == np.repeat(most, np.diff(np.append(begins, len(self.q)))))
            self.top[self.src[is_top]] = is_top  # of equals the last
            self.top_q[has] = self.q[self.top[has]]
            self.top_from[has] = np.where(self.top[has] > begins, cum[np.maximum(self.top[has] - 1, 0)], 0.0)


class _Grown:
    """An array that values are put behind, its room widened by a quarter when it is full."""

    __slots__ = ("data", "size")

    def __init__(self, dtype: np.dtype):
        self.data, self.size = np.empty(0, dtype), 0

    def put(self, values: np.ndarray) -> np.ndarray:
        """All values, the new ones last."""
        end = self.size + len(values)
        if end > len(self.data):
            wider = np.empty(max(end, len(self.data) * 5 // 4), self.data.dtype)
            wider[: self.size] = self.data[: self.size]
            self.data = wider
        self.data[self.size : end] = values
        self.size = end
        return self.data[:end]


class _Numbers(dict):
    """Units by the order in which they were first asked for."""

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        return number


class Lattice:
    """The lattices of distinct units, with backward sums; units once met stay for later batches."""

    _COLUMNS = ("start", "piece", "logp", "dst", "first", "beta", "q", "key", "final", "top", "top_q", "top_from")

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._held: dict[str, _Grown] = {}
        self.clear()

    def clear(self) -> None:
        """Forgets all units; the room they took is used again."""
        self.numbers = _Numbers()
        self.units = self.nodes = self.edges = 0
        for column in self._held.values():
            column.size = 0

    def numbered(self, rows: list[list[str]]) -> list[np.ndarray]:
        """The numbers of each row's units; those not met before get their lattices."""
        number_of = self.numbers.__getitem__
        found = [np.fromiter(map(number_of, row), np.int64, len(row)) for row in rows]
        if self.units < len(self.numbers) or not self._held:
            self._add(list(islice(self.numbers, self.units, None)))
        return found

    def _add(self, units: list[str]) -> None:
        part = _Part(self.pieces, units)
        part.start += self.nodes
        part.first += self.edges
        part.dst += self.nodes
        part.key += self.nodes
        part.top += self.edges
        for name in self._COLUMNS:
            values = getattr(part, name)
            column = self._held.setdefault(name, _Grown(values.dtype))
            setattr(self, name, column.put(values[1:] if name == "first" and column.size else values))
        self.units, self.nodes, self.edges = len(self.start), len(self.beta), len(self.q)

    def sample(self, unit: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each unit's path by ancestral sampling: edges one unit after another, where each unit's begin, its log-probability."""
        node = self.start[unit]
        who = np.arange(len(unit))
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        while len(who):
            u = _uniform(_seeds(seeds[who], len(steps)))
            edge, most = self.top[node], self.top_q[node]
            others = np.flatnonzero(u >= most)
            if len(others):
                at, u = node[others], u[others] - most[others]
                u = np.where(u >= self.top_from[at], u + most[others], u)  # past the likeliest edge's share
                edge[others] = np.clip(np.searchsorted(self.key, at + u, side="right"), self.first[at], self.first[at + 1] - 1)
            steps.append((who, edge))
            node = self.dst[edge]
            going = ~self.final[node]
            who, node = who[going], node[going]
        counts = np.zeros(len(unit) + 1, np.int64)
        for w, _ in steps:
            counts[w + 1] += 1
        offset = np.cumsum(counts)
        edges = np.empty(offset[-1], np.int64)
        for k, (w, e) in enumerate(steps):
            edges[offset[w] + k] = e
        total = np.concatenate([[0.0], np.cumsum(np.log(np.maximum(self.q[edges], 1e-300)))])
        return edges, offset, np.minimum(total[offset[1:]] - total[offset[:-1]], 0.0)

    def sample_other(self, unit: int, taken: list[tuple[list[int], float]], seed: int) -> tuple[list[int], float]:
        """A path that is none of the taken ones (each with its probability), and its log-probability."""
        node, reach, path, logq = int(self.start[unit]), 1.0, [], 0.0
        while not self.final[node]:
            lo, hi = int(self.first[node]), int(self.first[node + 1])
            q = self.q[lo:hi]
            mass = reach * q
            for other, p in taken:
                mass[other[len(path)] - lo] -= p
            mass = np.maximum(mass, 0.0)
            total = mass.sum()
            u = _uniform_of(_seed(seed, len(path)))
            pick = int(np.argmax(q)) if total <= 0 else min(int(np.searchsorted(np.cumsum(mass), u * total, side="right")), hi - lo - 1)
            taken = [(other, p) for other, p in taken if other[len(path)] == lo + pick]
            reach *= float(q[pick])
            logq += float(np.log(max(q[pick], 1e-300)))
            path.append(lo + pick)
            node = int(self.dst[lo + pick])
        return path, min(logq, 0.0)


class _Path:
    """One drawn segmentation of a row: its units' edges and its regions' bounds."""

    __slots__ = ("bound", "edges", "left_out", "logp", "offset", "value")

    def __init__(self, value, edges, offset, logp):
        self.value, self.edges, self.offset, self.logp = value, edges, offset, logp
        self.bound: np.ndarray | None = None
        self.left_out: dict[int, list[tuple[list[int], float]]] = {}


def _bounds(before: np.ndarray, logp: np.ndarray, top: np.ndarray | float, seeds: np.ndarray) -> np.ndarray:
    """Truncated Gumbels of all other choices at each unit: before, the log-probability of the units ahead of it."""
    with np.errstate(divide="ignore", over="ignore"):
        rest = np.where(logp > -1e-12, -np.inf, np.log(-np.expm1(logp)))
        phi = before + rest
        return np.where(np.isneginf(phi), -np.inf, phi - np.log(np.exp(np.minimum(phi - top, 700.0)) - np.log(_uniform(_seeds(seeds, 1 << 20)))))


def sample_rows(pieces: Pieces, texts: list[str], keys: np.ndarray, k: int, lattice: Lattice | None = None) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text (blanks for U+2581): up to k of (ids, log-probability, perturbed value, log inclusion probability), best first.

    A lattice given holds the units of batches before, and this one's afterwards.
    """
    units = [_UNIT.findall(" " + t) if t else [] for t in texts]
    lattice = Lattice(pieces) if lattice is None else lattice
    per_row = lattice.numbered(units)
    del units
    base = _seeds(np.asarray(keys).astype(np.int64).view(np.uint64), 0)
    tops = -np.log(-np.log(_uniform(_seeds(base, 1 << 21))))
    found: list[list[_Path]] = [[] for _ in texts]

    def draw(jobs: list[tuple[int, int, float, _Path | None, list[int], float]], number: int) -> None:
        """For (row, from unit, value, parent, edges of the unit before it, their log-probability): the row's next path."""
        if not jobs:
            return
        todo = [per_row[r][i:] for r, i, *_ in jobs]
        sizes = [len(t) for t in todo]
        flat = np.concatenate([*todo, np.zeros(0, np.int64)])
        row_seed = _seeds(base[[j[0] for j in jobs]], number)
        where = np.concatenate([np.arange(j[1], j[1] + n) for j, n in zip(jobs, sizes, strict=True)])
        seeds = _seeds(np.repeat(row_seed, sizes), where)
        edges, offset, logp = lattice.sample(flat, seeds)
        running = np.concatenate([[0.0], np.cumsum(logp)])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        ahead = np.array([p.logp[: i - 1].sum() + lq if p else 0.0 for _, i, _, p, _, lq in jobs])
        before = running[:-1] - np.repeat(running[starts[:-1]], sizes) + np.repeat(ahead, sizes)
        bounds = _bounds(before, logp, np.repeat([j[2] for j in jobs], sizes), seeds)
        for n, (r, i, value, parent, own, lq) in enumerate(jobs):
            lo, hi = int(starts[n]), int(starts[n + 1])
            mine, off = edges[offset[lo] : offset[hi]], offset[lo : hi + 1] - offset[lo]
            if parent:
                kept = parent.edges[: parent.offset[i - 1]]
                path = _Path(value, np.concatenate([kept, np.array(own, np.int64), mine]), np.concatenate([parent.offset[:i], off + len(kept) + len(own)]), np.concatenate([parent.logp[: i - 1], [lq], logp[lo:hi]]))
                path.bound = np.concatenate([np.full(i, -np.inf), bounds[lo:hi]])
            else:
                path = _Path(value, mine, off, logp[lo:hi])
                path.bound = bounds[lo:hi]
            found[r].append(path)

    draw([(r, 0, float(tops[r]), None, [], 0.0) for r in range(len(texts))], 0)
    for number in range(1, k):
        jobs = []
        for r, paths in enumerate(found):
            best = max(paths, key=lambda p: p.bound.max(initial=-np.inf))
            value = float(best.bound.max(initial=-np.inf))
            if value == -np.inf:
                continue
            i = int(best.bound.argmax())
            taken = best.left_out.setdefault(i, [(best.edges[best.offset[i] : best.offset[i + 1]].tolist(), float(np.exp(best.logp[i])))])
            seed = _seed(_seed(int(base[r]), number), (1 << 22) + i)
            own, lq = lattice.sample_other(int(per_row[r][i]), taken, seed)
            taken.append((own, float(np.exp(lq))))
            gone = sum(p for _, p in taken)
            left = np.log1p(-gone) if gone < 1 - 1e-12 else -np.inf
            phi = float(best.logp[:i].sum() + left)
            best.bound[i] = -np.inf if phi == -np.inf else phi - np.log(np.exp(min(phi - value, 700.0)) - np.log(_uniform_of(_seed(seed, 1 << 20))))
            jobs.append((r, i + 1, value, best, own, lq))
        draw(jobs, number)
    out = []
    for paths in found:
        kappa = max((float(p.bound.max(initial=-np.inf)) for p in paths), default=-np.inf)
        row = []
        for p in paths[:k]:
            logp = float(p.logp.sum())
            with np.errstate(divide="ignore", over="ignore"):
                inclusion = 0.0 if kappa == -np.inf else float(np.log(-np.expm1(-np.exp(min(logp - kappa, 700.0)))))
                if inclusion == -np.inf:  # so small that it equals its rate
                    inclusion = logp - kappa
            row.append((_spelt(pieces, lattice.piece[p.edges]), logp, p.value, inclusion))
        out.append(row)
    return out


def _spelt(pieces: Pieces, found: np.ndarray) -> np.ndarray:
    """Piece ids, characters outside the vocabulary in byte pieces."""
    if not len(found) or found.min() >= 0:
        return found
    out: list[int] = []
    for x in found.tolist():
        out += [x] if x >= 0 else pieces.byte_id[list(chr(-1 - x).encode("utf-8", "surrogatepass"))].tolist()
    return np.array(out, np.int32)


def decode_ids(pieces: Pieces, ids: np.ndarray | list[int]) -> str:
    """The text of a sequence of ids."""
    text = b"".join(pieces.bytes_array[np.asarray(ids, np.int64)].tolist()).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def sample_encode(docs: DataFrame, model_path: str, k: int = 2, alpha: float = 0.5, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Up to k distinct segmentations of every row.

    Columns: doc_id, sample (from 1, largest perturbed value first), n_pieces,
    log_prob, perturbed, log_inclusion, ids, decoded_ok (the ids decode to the
    text).
    """
    bounded_batches(docs.sparkSession)
    kept = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.lit(seed), F.col(id_col).cast("string")).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = kept.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        pieces = load_pieces(model_path, alpha)
        lattice = Lattice(pieces)
        for batch in batches:
            doc_ids, keys, texts = batch.column("doc_id"), batch.column("key").to_numpy(), batch.column("text")
            start = 0
            while start < len(texts):
                some, held = [], 0
                while start + len(some) < len(texts) and (not some or held < BATCH_CHARS):
                    some.append(texts[start + len(some)].as_py())
                    held += len(some[-1])
                plain = [t.replace(BLANK, " ") for t in some]
                if lattice.nodes > HELD_NODES:  # most words recur: their lattices are kept while there is room
                    lattice.clear()
                rows = sample_rows(pieces, plain, keys[start : start + len(some)], k, lattice)
                flat = [(start + i, n, *x, decode_ids(pieces, x[0]) == some[i]) for i, row in enumerate(rows) for n, x in enumerate(row, 1)]
                start += len(some)
                offsets = np.concatenate([[0], np.cumsum([len(x[2]) for x in flat])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*[x[2] for x in flat], np.zeros(0, np.int32)]).astype(np.int32)))
                columns = [doc_ids.take(pa.array([x[0] for x in flat], pa.int64())), pa.array([x[1] for x in flat], pa.int32()), pa.array(np.diff(offsets), pa.int32()), *[pa.array([x[c] for x in flat], pa.float64()) for c in (3, 4, 5)], ids, pa.array([x[6] for x in flat], pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "log_inclusion", "ids", "decoded_ok"])
        _MODELS.clear()  # idle workers are kept for other stages: they need not keep the trie
        del pieces, lattice
        give_back()

    return kept.mapInArrow(run, f"doc_id {id_type}, sample int, n_pieces int, log_prob double, perturbed double, log_inclusion double, ids array<int>, decoded_ok boolean")
