"""Declared horizons of the covariance figures and baselines of carry, from a TOML file; unknown keys are refused.

    [varcov.1d]              bars, corr and what else Horizon has
    [carry]                  baseline = {main = .., other = ..}, dex = {other = [tickers]}
"""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators import aggs
from marketlake.plans import signals

#: Bar widths in micros that horizons may have (fixed values).
WIDTHS = {"1m": 60_000_000, "5m": 300_000_000, "30m": 1_800_000_000, "1h": 3_600_000_000, "4h": 14_400_000_000, "1d": 86_400_000_000, "1w": 604_800_000_000}
CORRELATIONS = ("dcc", "cdcc", "ccc", "ewma")


def _refuse(where: str, given: dict, allowed: set[str]) -> None:
    if extra := sorted(set(given) - allowed):
        raise ValueError(f"{where}: unknown key {', '.join(extra)}")


@dataclass(frozen=True)
class Horizon:
    name: str
    bars: str
    corr: str
    model: str = "garch"
    dist: str = "t"
    lam: float = 0.94
    deseasonalise: bool = False
    min_obs: int = 500

    def __post_init__(self) -> None:
        if self.name not in WIDTHS or self.bars not in WIDTHS:
            raise ValueError(f"varcov.{self.name}: no width that bars can be built of")
        if self.corr not in CORRELATIONS:
            raise ValueError(f"varcov.{self.name}: corr must be one of {', '.join(CORRELATIONS)}")

    def bars_of(self, fine: DataFrame) -> DataFrame:
        """Bars of the horizon's width from those of ``bars``."""
        own, from_ = WIDTHS[self.name], WIDTHS[self.bars]
        return fine if own == from_ else aggs.build_bars(fine, from_, own)

    def varcov(self, returns: DataFrame) -> DataFrame:
        """Covariance and correlation of the horizon's returns; the weights are its ``lam``, whichever model it names."""
        return signals.varcov(returns, self.lam, WIDTHS[self.name], self.name)


@dataclass(frozen=True)
class Baselines:
    """Interest-only hourly rate of each dex, and the tickers of the dexes other than main."""

    rates: dict[str, float]
    dex_of: dict[str, str] = field(default_factory=dict)

    def dex(self, ticker: Column) -> Column:
        return self._by(ticker, self.dex_of, "main")

    def rate(self, ticker: Column) -> Column:
        return self._by(ticker, {t: self.rates[x] for t, x in self.dex_of.items()}, self.rates["main"])

    def _by(self, ticker: Column, of: dict, other) -> Column:
        out = F.when(F.lit(False), F.lit(other))
        for t, v in of.items():
            out = out.when(ticker == t, F.lit(v))
        return out.otherwise(F.lit(other))


def horizons(table: dict) -> list[Horizon]:
    names = {f.name for f in fields(Horizon)} - {"name"}
    out = []
    for name, given in table.items():
        _refuse(f"varcov.{name}", given, names)
        if missing := {"bars", "corr"} - set(given):
            raise ValueError(f"varcov.{name}: {', '.join(sorted(missing))} missing")
        out.append(Horizon(name, **given))
    return out


def baselines(table: dict) -> Baselines:
    _refuse("carry", table, {"baseline", "dex"})
    rates, dexes = table.get("baseline", {}), table.get("dex", {})
    if "main" not in rates:
        raise ValueError("carry: no baseline of main")
    if unknown := sorted(set(dexes) - set(rates)):
        raise ValueError(f"carry: no baseline of {', '.join(unknown)}")
    return Baselines(dict(rates), {t: x for x, tickers in dexes.items() for t in tickers})


def load(path: str) -> tuple[list[Horizon], Baselines]:
    with open(path, "rb") as f:
        all_ = tomllib.load(f)
    _refuse("the file", all_, {"varcov", "carry"})
    return horizons(all_.get("varcov", {})), baselines(all_.get("carry", {}))
