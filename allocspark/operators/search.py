"""The constrained search for a batch of campaigns at once, as array arithmetic.

All campaigns of an Arrow batch walk their chords side by side: a try is one pass over
(campaigns x units) arrays, and a campaign leaves the arrays when its search has ended. What a
campaign gets depends on its own row and the program alone, not on its batch.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

from allocspark import schemas

TOLERANCE = 1e-12
#: Campaigns worked on together, so that their arrays stay in a core's cache.
TOGETHER = 1024

# Why the search always ends within its steps. At a fixed weight of seniors the fill changes only
# where a unit turns profitable or two units of a region change places: n(n+1)/2 prices for n units
# of a region, LINES in all. Each try either closes its bracket or finds another such fill. Weight
# and price together make every change a line in the plane; the weights at which the best fill for
# the budget changes are crossings of two lines. So no search makes more than (crossings + 3) *
# (LINES + 2) tries. An ended search leaves the arrays, so only the tries made cost time.
_UNITS = len(schemas.CHANNELS) * len(schemas.SENIORITIES)
LINES = len(schemas.REGIONS) * _UNITS * (_UNITS + 1) // 2
MOST_TRIES = (LINES * (LINES - 1) // 2 + 3) * (LINES + 2)

# Phases of the search: fill for hires; fill for senior hires; trade the two; ends.
FOR_HIRES, FOR_SENIORS, TRADING, SOLVED, OUT_OF_REACH, NO_ROOM, FLOORS_TOO_DEAR = range(7)

# Columns of a vertex: its direction (gain*a + senior_gain*b - cost*m), spend, hires and senior hires.
A, B, M, SPEND, HIRES, SENIOR = range(6)
# Columns of a mix: two vertices, the share of the first, and the hires and senior hires of both.
OVER, UNDER, SHARE, MIX_HIRES, MIX_SENIOR = slice(0, 6), slice(6, 12), 12, 13, 14


@dataclass(frozen=True)
class Units:
    """The corridors as arrays, in unit order, and the places of each region's units."""

    cost: np.ndarray
    gain: np.ndarray
    senior_gain: np.ndarray
    capacity: np.ndarray
    regions: list[np.ndarray]

    @classmethod
    def of(cls, units: list) -> Units:
        """From the program's units; one that lacks a figure has no capacity."""
        figures = ("cost", "gain", "senior_gain", "capacity")

        def column(name: str) -> np.ndarray:
            return np.array([0.0 if any(u[f] is None for f in figures) else u[name] for u in units], dtype=float)

        names = [u["region"] for u in units]
        regions = [np.array([i for i, n in enumerate(names) if n == name]) for name in dict.fromkeys(names)]
        return cls(column("cost"), column("gain"), column("senior_gain"), column("capacity"), regions)

    @cached_property
    def measures(self) -> np.ndarray:
        return np.stack([self.cost, self.gain, self.senior_gain], axis=1)


def _quotient(numerator: np.ndarray, denominator: np.ndarray) -> np.ndarray:
    """The quotient, zero for a zero denominator."""
    return np.divide(numerator, denominator, out=np.zeros_like(numerator), where=denominator != 0)


def _amounts(units: Units, direction: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """Applicants per campaign and unit of the best allocation in each campaign's direction.

    Profitable units are taken in full. Only a region whose floor they do not reach is
    ordered, to be filled up with its least unprofitable units; ties in unit order.
    """
    loss = direction[:, M, None] * units.cost - direction[:, A, None] * units.gain - direction[:, B, None] * units.senior_gain
    placed = np.where(loss < 0, units.capacity, 0.0)
    for region in units.regions:
        filled = placed[:, region].sum(axis=1)
        short = np.nonzero(filled < floor)[0]
        if len(short):
            prices = loss[np.ix_(short, region)]
            rest = prices >= 0
            order = np.argsort(np.where(rest, prices, np.inf), axis=1, kind="stable")
            sizes = np.take_along_axis(np.where(rest, units.capacity[region], 0.0), order, axis=1)
            before = filled[short, None] + np.cumsum(sizes, axis=1) - sizes
            taken = np.minimum(sizes, np.maximum(0.0, floor[short, None] - before))
            placed[short[:, None], region[order]] += taken
    return placed


def _vertex(units: Units, a, b, m, floor: np.ndarray) -> np.ndarray:
    """The best allocation in each direction, as its direction, spend, hires and senior hires."""
    found = np.empty((len(floor), 6))
    found[:, A], found[:, B], found[:, M] = a, b, m
    # Summed unit by unit, without a library whose order of sums depends on the batch.
    found[:, SPEND:] = np.einsum("nu,uk->nk", _amounts(units, found, floor), units.measures, optimize=False)
    return found


def _mix(over: np.ndarray, under: np.ndarray, share: np.ndarray) -> np.ndarray:
    ends = [share * over[:, kind] + (1 - share) * under[:, kind] for kind in (HIRES, SENIOR)]
    return np.column_stack([over, under, share, *ends])


def _beats(value: np.ndarray, chord: np.ndarray) -> np.ndarray:
    return value > chord + TOLERANCE * (1.0 + np.abs(chord))


def _where(condition: np.ndarray, yes: np.ndarray, no: np.ndarray) -> np.ndarray:
    return np.where(condition[:, None], yes, no)


class Search:
    """Walks the chords from the richest to the poorest vertex of each campaign.

    The state holds the weights (a, b) of the objective in hand, the two vertices that
    bracket the budget, and the two mixes that bracket the quota.
    """

    def __init__(self, units: Units, budget: np.ndarray, quota: np.ndarray, floor: np.ndarray):
        self.units, self.budget, self.quota, self.floor = units, budget, quota, floor
        n = len(budget)
        self.rich, poor = _vertex(units, 1.0, 0.0, 0.0, floor), _vertex(units, 0.0, 0.0, 1.0, floor)
        within = self.rich[:, SPEND] <= budget
        room = np.all([units.capacity[r].sum() >= floor for r in units.regions], axis=0) if units.regions else np.ones(n, bool)
        # With money for everything the richest vertex is best for every weighting of the two aims.
        self.less = _mix(self.rich, self.rich, np.ones(n))
        self.more = self.less.copy()
        self.a, self.b = np.ones(n), np.zeros(n)
        self.over, self.under = self.rich.copy(), poor.copy()
        self.quota_price, self.budget_price = np.zeros(n), np.zeros(n)
        self.phase = np.select(
            [~room, poor[:, SPEND] > budget, within & (self.rich[:, SENIOR] >= quota), within],
            [NO_ROOM, FLOORS_TOO_DEAR, SOLVED, OUT_OF_REACH], FOR_HIRES)

    def run(self) -> None:
        tries = 0
        while len(going := np.nonzero(self.phase < SOLVED)[0]) and tries < MOST_TRIES:
            self._try(going)
            tries += 1

    def _try(self, at: np.ndarray) -> None:
        """One try for each campaign of ``at``: the price at which its bracket's ends tie, never below zero."""
        a, b, over, under, budget = self.a[at], self.b[at], self.over[at], self.under[at], self.budget[at]

        def worth(point: np.ndarray) -> np.ndarray:
            return a * point[:, HIRES] + b * point[:, SENIOR]

        price = np.maximum(_quotient(worth(over) - worth(under), over[:, SPEND] - under[:, SPEND]), 0.0)
        tried = _vertex(self.units, a, b, price, self.floor[at])
        # The bracket after the try, and whether no vertex lies above its chord.
        better = _beats(worth(tried) - price * tried[:, SPEND], worth(under) - price * under[:, SPEND])
        free, affordable = price == 0, tried[:, SPEND] <= budget
        slack = free & affordable
        now_over = _where(slack, tried, _where(free & ~better, under, _where(better & ~affordable, tried, over)))
        now_under = _where(slack | (better & affordable), tried, under)
        self.over[at], self.under[at], self.budget_price[at] = now_over, now_under, price
        closed = np.nonzero(slack | ~better)[0]
        if len(closed):
            self._settle(at[closed], now_over[closed], now_under[closed])

    def _settle(self, at: np.ndarray, over: np.ndarray, under: np.ndarray) -> None:
        """The next state of the campaigns ``at``, whose brackets are closed."""
        budget, quota, phase, price = self.budget[at], self.quota[at], self.phase[at], self.quota_price[at]
        share = np.where(over[:, SPEND] <= budget, 1.0, _quotient(budget - under[:, SPEND], over[:, SPEND] - under[:, SPEND]))
        found, less, more = _mix(over, under, share), self.less[at], self.more[at]
        short = found[:, MIX_SENIOR] < quota
        gained = _beats(found[:, MIX_HIRES] + price * found[:, MIX_SENIOR], less[:, MIX_HIRES] + price * less[:, MIX_SENIOR])
        trading = phase == TRADING
        less = _where((phase == FOR_HIRES) | (trading & gained & short), found, less)
        more = _where((phase == FOR_SENIORS) | (trading & gained & ~short), found, more)
        following = np.select(
            [phase == FOR_HIRES, phase == FOR_SENIORS],
            [np.where(short, FOR_SENIORS, SOLVED), np.where(short, OUT_OF_REACH, TRADING)],
            np.where(gained, TRADING, SOLVED))
        trade = np.maximum(_quotient(less[:, MIX_HIRES] - more[:, MIX_HIRES], more[:, MIX_SENIOR] - less[:, MIX_SENIOR]), 0.0)
        seniors, goes_on = following == FOR_SENIORS, following == TRADING
        self.a[at] = np.where(seniors, 0.0, 1.0)
        self.b[at] = np.where(seniors, 1.0, np.where(goes_on, trade, 0.0))
        self.over[at] = _where(over[:, SPEND] > budget, over, self.rich[at])
        self.less[at], self.more[at], self.phase[at] = less, more, following
        self.quota_price[at] = np.where(goes_on, trade, price)

    def amounts(self) -> np.ndarray:
        """Applicants per campaign and unit: the mix of the two ends; zero where there is no plan."""
        less, more, quota = self.less, self.more, self.quota
        # Share of ``less``: all of it where it meets the quota, else what hits the quota exactly.
        share = np.where(less[:, MIX_SENIOR] >= quota, 1.0, _quotient(
            more[:, MIX_SENIOR] - quota, more[:, MIX_SENIOR] - less[:, MIX_SENIOR]))
        total = np.zeros((len(quota), len(self.units.cost)))
        for ends, part in ((less, share), (more, 1 - share)):
            for vertex, weight in ((ends[:, OVER], part * ends[:, SHARE]), (ends[:, UNDER], part * (1 - ends[:, SHARE]))):
                used = np.nonzero((weight > 0) & (self.phase == SOLVED))[0]
                total[used] += weight[used, None] * _amounts(self.units, vertex[used], self.floor[used])
        return total

    def dual_bound(self) -> np.ndarray:
        best = _vertex(self.units, 1.0, self.quota_price, self.budget_price, self.floor)
        return best[:, HIRES] + self.quota_price * (best[:, SENIOR] - self.quota) - self.budget_price * (best[:, SPEND] - self.budget)


def solve(units: Units, budget: np.ndarray, quota: np.ndarray, floor: np.ndarray) -> dict[str, np.ndarray]:
    """Phase, amounts, prices and dual bound of every campaign."""
    parts = []
    for first in range(0, len(budget), TOGETHER):
        some = slice(first, first + TOGETHER)
        search = Search(units, budget[some], quota[some], floor[some])
        search.run()
        parts.append({"phase": search.phase, "amounts": search.amounts(), "budget_price": search.budget_price,
                      "quota_price": search.quota_price, "dual_bound": search.dual_bound()})
    return {name: np.concatenate([part[name] for part in parts]) for name in parts[0]}
