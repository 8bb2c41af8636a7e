"""Model registry: a model is a function whose parameters name its input tables."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    options: tuple[str, ...]
    unique_key: tuple[str, ...]
    date_col: str | None
    date_expr: str | None
    cluster: tuple[str, ...]


MODELS: dict[str, Model] = {}


def model(layer: str, unique_key=(), date_col: str | None = None, cluster=(), date_expr: str | None = None):
    """Register a table function.  Positional parameters are inputs, keyword-only ones options.

    ``date_col`` names the ``YYYYMMDD`` key by which the stored model is laid out and bounded;
    where no column is one, ``date_expr`` computes it.
    """

    def wrap(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        params = inspect.signature(fn).parameters.values()
        MODELS[fn.__name__] = Model(
            fn.__name__,
            layer,
            fn,
            tuple(p.name for p in params if p.kind is p.POSITIONAL_OR_KEYWORD),
            tuple(p.name for p in params if p.kind is p.KEYWORD_ONLY),
            tuple(unique_key),
            date_col,
            date_expr,
            tuple(cluster),
        )
        return fn

    return wrap


class Warehouse(Mapping):
    """Source tables plus every registered model built on them, resolved on demand.

    Nothing runs here: each entry is a lazy DataFrame, built once and shared by all
    models that read it.
    """

    def __init__(self, sources: Mapping[str, DataFrame], **options):
        self._sources, self._options = sources, options
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._built:
            return self._built[name]
        if name not in MODELS:
            return self._sources[name]
        self._built[name] = self.build(name)
        return self._built[name]

    def build(self, name: str, **options) -> DataFrame:
        """A fresh build of one model; ``options`` add to those given for all models."""
        m = MODELS[name]
        wanted = {k: v for k, v in {**self._options, **options}.items() if k in m.options}
        return m.build(*[self[i] for i in m.inputs], **wanted)

    def put(self, name: str, df: DataFrame) -> None:
        """Use a stored table in place of a model, e.g. after it was materialised."""
        self._built[name] = df

    def __iter__(self):
        return iter([*self._sources, *MODELS])

    def __len__(self):
        return len(self._sources) + len(MODELS)


def select_layer(layer: str) -> list[str]:
    """Models of one layer in dependency order (registration order is definition order)."""
    return [m.name for m in MODELS.values() if m.layer == layer]


def build_waves(names: Iterable[str]) -> list[list[str]]:
    """The models in waves: each reads only models of earlier waves, so a wave can run side by side.

    Models that are not among ``names`` are no dependencies: they are computed where they are read.
    """
    wanted, depth = list(names), {}

    def level(name: str) -> int:
        if name not in depth:
            inputs = [i for i in MODELS[name].inputs if i in wanted]
            depth[name] = 1 + max(map(level, inputs), default=-1)
        return depth[name]

    waves: list[list[str]] = [[] for _ in range(1 + max(map(level, wanted), default=-1))]
    for name in wanted:
        waves[level(name)].append(name)
    return waves
