"""Models with declared inputs: their order, a choice of them, and runs that go on from where they failed.

A model is a function from its inputs to a table. Its layer is the one it is written to; a view is not written at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stratalake.checks.runner import Check, run_checks
from stratalake.sources.layers import layer_path, new_version, publish_view, read_layer, switch_to, write_table

DONE, FAILED, SKIPPED = "done", "failed", "skipped"
STATES = "run string, model string, layer string, level int, state string, message string"


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    cluster_by: tuple[str, ...] = ()
    is_view: bool = False
    # What the ranges of the layout are taken from, if that is cheaper to read than the model.
    sample_from: str | None = None


class RunFailed(RuntimeError):
    """Some models failed; the others are done or depend on them."""

    def __init__(self, states: DataFrame, messages: list[str]) -> None:
        super().__init__("; ".join(messages))
        self.states = states


class ModelGraph:
    """Models in the order of their declared inputs; names that no model has are sources."""

    def __init__(self, models: Iterable[Model]) -> None:
        self.models = {}
        for model in models:
            if model.name in self.models:
                raise ValueError(f"model {model.name!r} is declared twice")
            self.models[model.name] = model
        self.levels: dict[str, int] = {}
        for name in self.models:
            self._level(name, ())
        self.order = sorted(self.models, key=lambda n: (self.levels[n], list(self.models).index(n)))

    def _level(self, name: str, above: tuple[str, ...]) -> int:
        if name in above:
            raise ValueError("models depend on themselves: " + " -> ".join([*above[above.index(name) :], name]))
        if name not in self.models:
            return 0
        if name not in self.levels:
            self.levels[name] = 1 + max([self._level(i, (*above, name)) for i in self.models[name].inputs], default=0)
        return self.levels[name]

    @property
    def sources(self) -> list[str]:
        return sorted({i for m in self.models.values() for i in m.inputs} - set(self.models))

    def upstream(self, name: str) -> set[str]:
        """All models that this one is built from."""
        direct = [i for i in self.models[name].inputs if i in self.models]
        return set(direct).union(*[self.upstream(i) for i in direct])

    def downstream(self, name: str) -> set[str]:
        return {n for n in self.models if name in self.upstream(n)}

    def select(self, *choices: str) -> list[str]:
        """Models in order. A choice is a name, ``+name`` with all it is built from, ``name+`` with all built from it,
        ``+name+``, or ``layer:`` and a layer. No choice chooses all."""
        chosen: set[str] = set()
        for choice in choices or ("+",):
            if choice == "+":
                chosen |= set(self.models)
            elif choice.startswith("layer:"):
                found = {n for n, m in self.models.items() if m.layer == choice.removeprefix("layer:")}
                if not found:
                    raise ValueError(f"no model is in {choice}")
                chosen |= found
            else:
                name = choice.strip("+")
                if name not in self.models:
                    raise ValueError(f"there is no model {name!r}")
                chosen.add(name)
                if choice.startswith("+"):
                    chosen |= self.upstream(name)
                if choice.endswith("+"):
                    chosen |= self.downstream(name)
        return [n for n in self.order if n in chosen]

    def plans(self, sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """All models as plans over the sources, nothing written."""
        tables = dict(sources)
        for name in self.order:
            tables[name] = self.models[name].build(*[tables[i] for i in self.models[name].inputs])
        return {name: tables[name] for name in self.order}

    def run(
        self,
        sources: Mapping[str, DataFrame],
        root: str,
        select: Iterable[str] = (),
        checks: Callable[[Mapping[str, DataFrame]], Mapping[str, list[Check]]] = lambda tables: {},
        resume: bool = False,
    ) -> dict[str, DataFrame]:
        """Writes the chosen models below ``root``, each level's side by side, and returns them.

        ``checks`` gives the checks of a model, from itself and the models it is built from.
        Inputs that are not chosen are read from an earlier run. A model is switched to its new version
        when its checks of severity error have passed. When a model fails, those built from it are skipped, all others are run,
        and ``RunFailed`` follows. The state of each model is kept in ``<root>/runs/states``; with ``resume`` the models that
        are done there are read instead of run.
        """
        spark = next(iter(sources.values())).sparkSession
        chosen, run_id = self.select(*select), uuid.uuid4().hex
        done_before = set()
        if resume:
            before = read_layer(spark, root, "runs", "states").filter(f"state = '{DONE}'").select("model")
            done_before = {row["model"] for row in before.collect()} & set(chosen)
        tables: dict[str, DataFrame] = dict(sources)
        states: dict[str, tuple[str, str]] = {}

        def ready(name: str) -> DataFrame:
            if name not in tables:
                tables[name] = self._read(spark, root, name, tables, ready)
            return tables[name]

        def attempt(name: str) -> tuple[str, str]:
            try:
                tables[name] = self._build(spark, root, self.models[name], ready, tables, checks)
                return DONE, ""
            except Exception as error:  # noqa: BLE001 - any failure of a model is a state of the run
                return FAILED, f"{type(error).__name__}: {error}"[:2000]

        for level in sorted({self.levels[n] for n in chosen}):
            names = []
            for name in (n for n in chosen if self.levels[n] == level):
                if any(states.get(i, (DONE,))[0] != DONE for i in self.models[name].inputs):
                    states[name] = (SKIPPED, "")
                elif name in done_before:
                    states[name] = (DONE, "")
                    ready(name)
                else:
                    for i in self.models[name].inputs:
                        ready(i)
                    names.append(name)
            if names:
                with ThreadPoolExecutor(len(names)) as pool:
                    states.update(zip(names, pool.map(attempt, names)))
            self._keep(spark, root, run_id, chosen, states)
        failed = [f"{n}: {message}" for n, (state, message) in states.items() if state == FAILED]
        if failed:
            raise RunFailed(read_layer(spark, root, "runs", "states"), failed)
        return {n: tables[n] for n in chosen}

    def _read(self, spark, root, name, tables, ready) -> DataFrame:
        model = self.models.get(name)
        if model is None:
            raise KeyError(f"there is no source {name!r}")
        if model.is_view:
            return model.build(*[ready(i) for i in model.inputs])
        return read_layer(spark, root, model.layer, name)

    def _build(self, spark, root, model, ready, tables, checks) -> DataFrame:
        plan = model.build(*[ready(i) for i in model.inputs])
        if model.is_view:
            return publish_view(plan, model.name)
        path = layer_path(root, model.layer, model.name)
        sample = ready(model.sample_from) if model.sample_from else None
        version = new_version(plan, path, list(model.cluster_by), sample)
        table = spark.read.schema(plan.schema).parquet(version)
        above = {name: tables[name] for name in self.upstream(model.name) if name in tables}
        listed = checks({**above, model.name: table}).get(model.name)
        if listed:
            report = run_checks(table, listed)
            write_table(report, layer_path(root, "checks", model.name))
            failed = read_layer(spark, root, "checks", model.name).filter("status = 'fail'").collect()
            if failed:
                raise ValueError(", ".join(f"check {r.check_name} found {r.failures}" for r in failed))
        switch_to(spark, path, version)
        return table

    def _keep(self, spark: SparkSession, root: str, run_id: str, chosen: list[str], states: Mapping[str, tuple[str, str]]) -> None:
        rows = [(run_id, n, self.models[n].layer, self.levels[n], *states[n]) for n in chosen if n in states]
        write_table(spark.createDataFrame(rows, STATES).coalesce(1), layer_path(root, "runs", "states"))
