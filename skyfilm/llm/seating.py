"""Chinese restaurants in arrays: tables of many dishes, customers that leave and sit down, and likelihoods of the seating."""

from __future__ import annotations

import numpy as np

#: the grid on which discount and strength are drawn
DISCOUNTS = np.linspace(0.02, 0.98, 33)
STRENGTHS = np.geomspace(0.05, 5000, 17)
#: dishes of up to so many customers move them one by one, others in so many blocks
RESEATED, BLOCKS = 64, 8
#: about how many customers are in memory at a time, whole dishes at least
HELD = 1 << 21


def runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all runs [start, start + size), one after another."""
    end = np.cumsum(size)
    return np.repeat(start - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)


def log_gamma(x: np.ndarray) -> np.ndarray:
    z = np.asarray(x, np.float64) + 7
    shift = np.log(np.prod([z - i for i in range(1, 8)], axis=0))
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - shift


class Tables:
    """Tables of dishes: c customers and ``used`` tables each, sizes of all tables dish by dish.

    room is how many tables each dish may come to have beyond those it has.  All moves go over the first n dishes, so
    dishes are best in falling order of how many moves they make.
    """

    def __init__(self, c: np.ndarray, used: np.ndarray, sizes: np.ndarray, room: np.ndarray):
        self.c, self.used = c.astype(np.int64), used.astype(np.int64)
        slots = self.used + room
        self.at = np.append(0, np.cumsum(slots))
        self.size = np.zeros(self.at[-1], np.int64)
        self.size[runs(self.at[:-1], self.used)] = sizes

    def sizes(self) -> np.ndarray:
        return self.size[runs(self.at[:-1], self.used)]

    def _customers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Customers up to and with each table, and before each dish."""
        return np.cumsum(self.size[: self.at[n]]), np.cumsum(self.c[:n]) - self.c[:n]

    def leave(self, n: int, rng: np.random.Generator) -> np.ndarray:
        """A customer of each dish, chosen at random, leaves; whether a table is gone with it."""
        until, before = self._customers(n)
        k = np.searchsorted(until, before + (rng.random(n) * self.c[:n]).astype(np.int64), side="right")
        self.size[k] -= 1
        gone = self.size[k] == 0
        k, last = k[gone], (self.at[:n] + self.used[:n] - 1)[gone]
        self.size[k] = self.size[last]
        self.size[last] = 0
        self.used[:n] -= gone
        self.c[:n] -= 1
        return gone

    def sit(self, n: int, new: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
        """A customer of each dish sits down: at a new table by weight ``new``, at one of size s by s - discount; whether it is new."""
        c, used = self.c[:n], self.used[:n]
        opens = (c == 0) | (rng.random(n) * (new + c - discount * used) < new)
        until, before = self._customers(n)
        slot, rest = self.at[:n] + used, np.flatnonzero(~opens)
        while len(rest):
            # the table of a random customer, kept with probability 1 - discount / size
            k = np.searchsorted(until, before[rest] + (rng.random(len(rest)) * c[rest]).astype(np.int64), side="right")
            kept = rng.random(len(rest)) * self.size[k] < self.size[k] - discount
            slot[rest[kept]] = k[kept]
            rest = rest[~kept]
        self.size[slot] += 1
        self.used[:n] += opens
        self.c[:n] += 1
        return opens


def first_tables(c: np.ndarray, new: float, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Where sampling starts: a number of tables for each dish, drawn for growing groups of its customers."""
    tables = (c > 0).astype(np.int64)
    left, seated = np.flatnonzero(c > 1), 1
    while len(left):
        step = max(1, seated // 4)
        n = np.minimum(c[left] - seated, step)
        tables[left] += rng.binomial(n, new / (new + np.maximum(seated - discount * tables[left], 1e-9)))
        seated += step
        left = left[c[left] > seated]
    return tables


def first_sizes(c: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """One customer at each table and the rest at the first of each dish."""
    sizes = np.ones(int(tables.sum()), np.int64)
    own = tables > 0
    sizes[(np.cumsum(tables) - tables)[own]] += (c - tables)[own]
    return sizes


def reseat(c: np.ndarray, used: np.ndarray, sizes: np.ndarray, group: np.ndarray, in_group: np.ndarray, parent: np.ndarray, discount: float, strength: float, rng: np.random.Generator, most: int = RESEATED) -> tuple[np.ndarray, np.ndarray]:
    """A Gibbs scan: as many moves as there are customers, who leave and sit down again given all others.

    group is the restaurant of each dish and in_group its tables, kept up to date in place; parent is the parent restaurant's probability of each dish.
    Dishes of up to ``most`` customers let a random one leave as often as they have customers, the others let all of them leave block by block
    (``reseat_blocks``); both leave the distribution of the seating as it is.  Dishes of a restaurant move side by side, one customer or one block of each at a time.
    """
    often = c > max(most, 1)
    few, many = np.flatnonzero(~often), np.flatnonzero(often)
    few = few[np.argsort(-c[few], kind="stable")]
    start = np.cumsum(used) - used
    own, moves, shares = group[few], c[few], parent[few]
    tables = Tables(moves, used[few], sizes[runs(start[few], used[few])], moves - used[few])
    for n in np.searchsorted(-moves, -np.arange(int(moves.max(initial=0))), side="left").tolist():
        gone = tables.leave(n, rng)
        # this customer's own table, if it is gone, no longer counts; those of the other dishes' leavers still do
        opens = tables.sit(n, (strength + discount * (in_group[own[:n]] - gone)) * shares[:n], discount, rng)
        change = opens.astype(np.int64) - gone
        np.add.at(in_group, own[:n][change != 0], change[change != 0])
    parts = [(few, tables.used, tables.sizes())]
    for part in _held(many, c[many]):
        parts.append((part, *reseat_blocks(c[part], used[part], sizes[runs(start[part], used[part])], group[part], in_group, parent[part], discount, strength, rng)))
    return _in_order(parts)


def _held(dishes: np.ndarray, customers: np.ndarray) -> list[np.ndarray]:
    """Dishes in parts of about ``HELD`` customers."""
    return [part for part in np.split(dishes, np.flatnonzero(np.diff(np.cumsum(customers) // HELD)) + 1) if len(part)]


def _in_order(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and sizes of the tables of all dishes from parts of them: (dishes, their numbers of tables, sizes dish by dish)."""
    dishes, used, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
    back = np.empty(len(dishes), np.int64)
    back[dishes] = np.arange(len(dishes))
    start = np.cumsum(used) - used
    return used[back], sizes[runs(start[back], used[back])]


def _openings(total: np.ndarray, new: np.ndarray, rise: np.ndarray, less: np.ndarray, m: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(dish, place) of those of m customers, who sit down one after another, that open a table.

    The customer at place i, after j new tables, opens one by weight new + rise * j of total + i - less * j.
    """
    who, place, draw = np.repeat(np.arange(len(m)), m), runs(0 * m, m), rng.random(int(m.sum()))
    gap, slope = draw * (np.repeat(total, m) + place) - np.repeat(new, m), np.repeat(rise, m) + draw * np.repeat(less, m)
    count = np.bincount(who[gap < 0], minlength=len(m))
    # without a first one there is no other; as long as no dish opens more than most, only these can open one
    most = np.where(count > 0, 2 * count + 8, 0)
    while True:
        at = np.flatnonzero(gap < np.repeat(most, m) * slope)
        dish, g, s = who[at], gap[at], slope[at]
        begin, opens = np.searchsorted(dish, np.arange(len(m))), g < 0
        # whether a customer opens a table follows from those before it, so this settles where one after another would lead
        while True:
            before = np.append(0, np.cumsum(opens))
            again = g < (before[:-1] - before[begin][dish]) * s
            if (again == opens).all():
                break
            opens = again
        count = np.bincount(dish[opens], minlength=len(m))
        if (count <= most).all():
            return dish[opens], place[at[opens]]
        most = np.where(count > most, 2 * count + 8, most)


def _log_sums(total: np.ndarray, less: np.ndarray, m: np.ndarray, dish: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each dish the log of the product of total + i - less * j over places i < m, with j tables opened before, at these places."""
    count = np.bincount(dish, minlength=len(m))
    first = np.cumsum(count) - count
    j = np.arange(len(dish)) - first[dish] + 1
    end = np.append(place[1:] + 1, 0)
    end[np.flatnonzero(j == count[dish])] = m[count > 0]
    start = m.copy()
    start[count > 0] = place[first[count > 0]] + 1
    sums = total[dish] - less[dish] * j
    return log_gamma(total + start) - log_gamma(total) + np.bincount(dish, weights=log_gamma(sums + end) - log_gamma(sums + place + 1), minlength=len(m))


def _joined(stayed: np.ndarray, tables: np.ndarray, m: np.ndarray, dish: np.ndarray, place: np.ndarray, discount: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """How many of m customers come to sit at each table opened at (dish, place), and how many of each dish at those ``tables`` of ``stayed`` customers before."""
    count, fresh = np.bincount(dish, minlength=len(m)), np.ones(len(dish), np.int64)
    last, end, rest = np.cumsum(count) - 1, m.copy(), np.zeros(len(m), np.int64)
    # from the last new table to the first: of those who came later, these sat there and the others at what was there before it
    for r in range(int(count.max(initial=0))):
        d = np.flatnonzero(count > r)
        k = last[d] - r
        later = end[d] - place[k] - 1 + rest[d]
        others = stayed[d] + place[k] - discount * (tables[d] + count[d] - 1 - r)
        here = np.where(others > 0, rng.binomial(later, rng.beta(1 - discount, np.maximum(others, 1e-9))), later)
        fresh[k] += here
        rest[d], end[d] = later - here, place[k]
    return fresh, rest + end


def _join(size: np.ndarray, owner: np.ndarray, rest: np.ndarray, discount: float, rng: np.random.Generator) -> None:
    """rest customers of each dish join its tables, of a size over 0, by size less discount one after another; a draw of the tables' shares first is the same."""
    there = np.flatnonzero((size > 0) & (rest[owner] > 0))
    there = there[np.argsort(owner[there], kind="stable")]
    count = np.bincount(owner[there], minlength=len(rest))
    end = np.cumsum(count)
    alone = count == 1
    size[there[end[alone] - 1]] += rest[alone]
    several = np.where(alone, 0, rest)
    until = np.append(0, np.cumsum(rng.standard_gamma(size[there] - discount)))
    low, high = np.repeat(end - count, several), np.repeat(end, several)
    k = np.searchsorted(until, until[low] + rng.random(len(low)) * (until[high] - until[low]), side="right") - 1
    size[there] += np.bincount(np.clip(k, low, high - 1), minlength=len(there))


def reseat_blocks(c: np.ndarray, used: np.ndarray, sizes: np.ndarray, group: np.ndarray, in_group: np.ndarray, parent: np.ndarray, discount: float, strength: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """A scan that lets the customers of each dish, two at least and in a random order, leave in ``BLOCKS`` blocks, each of which sits down again one after another.

    How often one of a block opens a table or joins one has the weights of the seating; the sum of the weights at each step, which depends on the tables opened
    before, is made up for by taking the block's new seats with probability min(1, new product of sums / old one), the old one in the same order.
    """
    used, size, owner = used.astype(np.int64), sizes.astype(np.int64), np.repeat(np.arange(len(c)), used)
    start = np.cumsum(c) - c
    at_table = np.repeat(np.arange(len(size)), size)
    at_table = at_table[np.argsort((np.repeat(np.arange(len(c)), c) << 32) | rng.integers(0, 1 << 32, len(at_table)))]
    for block in range(BLOCKS):
        low, high = c * block // BLOCKS, c * (block + 1) // BLOCKS
        own = np.flatnonzero(high > low)
        m = (high - low)[own]
        left = at_table[runs(start[own] + low[own], m)]
        gone = np.bincount(left, minlength=len(size))
        empty = (gone > 0) & (gone == size)
        size -= gone
        stayed, tables, p = (c[own] - m), (used - np.bincount(owner[empty], minlength=len(c)))[own], parent[own]
        new = (strength + discount * (in_group[group[own]] - used[own] + tables)) * p
        total, less, rise = stayed - discount * tables + new, discount * (1 - p), discount * p
        # the tables that only this block had were opened by the first of each
        at = np.flatnonzero(empty[left])
        at = np.sort(at[np.unique(left[at], return_index=True)[1]])
        begin = np.cumsum(m) - m
        opened = np.searchsorted(begin, at, side="right") - 1
        old = _log_sums(total, less, m, opened, at - begin[opened])
        dish, place = _openings(total, new, rise, less, m, rng)
        taken = np.log1p(-rng.random(len(own))) <= _log_sums(total, less, m, dish, place) - old
        size += np.bincount(left[np.repeat(~taken, m)], minlength=len(size))
        dish, place = dish[taken[dish]], place[taken[dish]]
        fresh, others = _joined(stayed, tables, m, dish, place, discount, rng)
        rest = np.zeros(len(c), np.int64)
        rest[own[taken]] = others[taken]
        _join(size, owner, rest, discount, rng)
        size, owner = np.append(size, fresh), np.append(owner, own[dish])
        before, used = used, np.bincount(owner[size > 0], minlength=len(c))
        np.add.at(in_group, group, used - before)
    there = np.flatnonzero(size)
    return used, size[there[np.argsort(owner[there], kind="stable")]]


def follow(c: np.ndarray, used: np.ndarray, sizes: np.ndarray, wanted: np.ndarray, new: float, discount: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Customers leave or sit down one by one until each dish has ``wanted`` of them; of a dish with more than ``RESEATED`` moves all at once, with the same outcome."""
    for sign in (-1, 1):
        moves = np.maximum(sign * (wanted - c), 0)
        few, many = np.flatnonzero(moves <= RESEATED), np.flatnonzero(moves > RESEATED)
        few = few[np.argsort(-moves[few], kind="stable")]
        start, steps = np.cumsum(used) - used, moves[few]
        tables = Tables(c[few], used[few], sizes[runs(start[few], used[few])], (steps if sign > 0 else 0 * steps))
        for n in np.searchsorted(-steps, -np.arange(int(steps.max(initial=0))), side="left").tolist():
            if sign < 0:
                tables.leave(n, rng)
            else:
                tables.sit(n, np.full(n, new), discount, rng)
        parts = [(few, tables.used, tables.sizes())]
        for part in _held(many, moves[many]):
            size, owner, m = sizes[runs(start[part], used[part])], np.repeat(np.arange(len(part)), used[part]), moves[part]
            if sign < 0:
                ends = np.cumsum(used[part])
                for d, (i, j) in enumerate(zip((ends - used[part]).tolist(), ends.tolist(), strict=True)):
                    size[i:j] -= rng.multivariate_hypergeometric(size[i:j], m[d], method="marginals")
            else:
                none = np.zeros(len(part))
                dish, place = _openings(c[part] - discount * used[part] + new, none + new, none, none + discount, m, rng)
                fresh, rest = _joined(c[part], used[part], m, dish, place, discount, rng)
                _join(size, owner, rest, discount, rng)
                size, owner = np.append(size, fresh), np.append(owner, dish)
            there = np.flatnonzero(size)
            there = there[np.argsort(owner[there], kind="stable")]
            parts.append((part, np.bincount(owner[there], minlength=len(part)), size[there]))
        used, sizes = _in_order(parts)
        c = c + sign * moves
    return used, sizes


def table_likelihood(sizes: np.ndarray) -> np.ndarray:
    """For each discount of the grid, the log likelihood of tables of these sizes."""
    s, n = np.unique(sizes[sizes > 1], return_counts=True)
    return np.array([(n * (log_gamma(s - d) - log_gamma(np.array([1 - d])))).sum() for d in DISCOUNTS])


def restaurant_likelihood(customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """For each discount and strength of the grid, the log likelihood of restaurants with so many customers and tables, flat."""
    c, cn = np.unique(customers[customers > 0], return_counts=True)
    t, tn = np.unique(tables[tables > 0], return_counts=True)
    out = np.zeros((len(DISCOUNTS), len(STRENGTHS)))
    for j, s in enumerate(STRENGTHS):
        out[:, j] -= (cn * (log_gamma(s + c) - log_gamma(np.array([s + 1])))).sum()
        for i, d in enumerate(DISCOUNTS):
            out[i, j] += (tn * ((t - 1) * np.log(d) + log_gamma(s / d + t) - log_gamma(np.array([s / d + 1])))).sum()
    return out.reshape(-1)


def draw(tables: np.ndarray, restaurants: np.ndarray, rng: np.random.Generator) -> tuple[float, float]:
    """Discount and strength, drawn from the grid given the seating."""
    log_p = (restaurants.reshape(len(DISCOUNTS), -1) + tables[:, None]).reshape(-1)
    p = np.exp(log_p - log_p.max())
    i = int(rng.choice(len(p), p=p / p.sum()))
    return float(DISCOUNTS[i // len(STRENGTHS)]), float(STRENGTHS[i % len(STRENGTHS)])
