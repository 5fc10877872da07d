"""Fit-once, apply-many preparation, and the whole data preparation run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.operators import clean, encode, scale
from tablewarden.operators.features import NUMERIC_FEATURES, engineer_features, interaction_maxima
from tablewarden.operators.split import stratified_split
from tablewarden.operators.validate import validation_report
from tablewarden.session import compiled, materialize, parts_for
from tablewarden.sources.tables import write_splits
from tablewarden.spec import TableSpec

SPLITS = ("train", "test", "val")
STATE_SCHEMA = "ord int, kind string, column string, pos int, value_str string, value_dbl double"


@dataclass
class PrepState:
    """Everything learned from the training rows. Its size depends on columns and levels only."""

    strategy: str = "mean"
    scaling: str = "standard"
    encoding: str = "onehot"
    fill: dict[str, object] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)
    scaler: dict[str, tuple[float, float]] = field(default_factory=dict)
    feature_fill: dict[str, float] = field(default_factory=dict)
    maxima: dict[str, float] = field(default_factory=dict)
    feature_names: list[str] = field(default_factory=list)
    codes: DataFrame | None = None
    distinct: DataFrame | None = None  # stored training rows of this session, see fit; not saved

    def rows(self) -> list[tuple]:
        out: list[tuple] = [
            ("option", k, 0, v, None)
            for k, v in (("strategy", self.strategy), ("scaling", self.scaling), ("encoding", self.encoding))
        ]
        for c, v in self.fill.items():
            text = isinstance(v, str)
            out.append(("fill", c, 0, v if text else None, None if text else float(v)))
        out += [("level", c, i, v, None) for c, vs in self.levels.items() for i, v in enumerate(vs)]
        for c, (center, spread) in self.scaler.items():
            out += [("scale", c, 0, None, float(center)), ("scale", c, 1, None, float(spread))]
        out += [("feature_fill", c, 0, None, float(v)) for c, v in self.feature_fill.items()]
        out += [("maximum", c, 0, None, float(v)) for c, v in self.maxima.items()]
        out += [("feature", c, i, None, None) for i, c in enumerate(self.feature_names)]
        return [(i, *row) for i, row in enumerate(out)]

    def as_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), STATE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.as_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/state")
        if self.codes is not None:
            self.codes.write.mode("overwrite").parquet(f"{path}/codes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PrepState:
        state = cls()
        for r in spark.read.parquet(f"{path}/state").orderBy("ord").collect():
            kind, c = r["kind"], r["column"]
            if kind == "option":
                setattr(state, c, r["value_str"])
            elif kind == "fill":
                state.fill[c] = r["value_str"] if r["value_str"] is not None else r["value_dbl"]
            elif kind == "level":
                state.levels.setdefault(c, []).append(r["value_str"])
            elif kind == "scale":
                state.scaler[c] = (*state.scaler.get(c, ()), r["value_dbl"])
            elif kind == "feature_fill":
                state.feature_fill[c] = r["value_dbl"]
            elif kind == "maximum":
                state.maxima[c] = r["value_dbl"]
            elif kind == "feature":
                state.feature_names.append(c)
        if state.encoding in ("label", "target"):
            state.codes = spark.read.parquet(f"{path}/codes")
        return state


def _learn_levels(df: DataFrame, spec: TableSpec, strategy: str) -> tuple[dict[str, str], dict[str, list[str]]]:
    """Modes of the configured categories and one-hot levels of all, from one aggregation."""
    columns = encode.categorical_columns(df.drop(spec.target), spec)
    plain = [c for c in columns if c not in encode.BINNED_LEVELS]
    counts = encode.few_levels(clean.level_counts(df, plain)) if plain else []
    mode: dict[str, str] = {}
    seen: dict[str, list[str]] = {c: [] for c in plain}
    for r in sorted(counts, key=lambda r: (-r["n"], r["value"])):
        if r["column"] in spec.categorical and strategy != "drop":
            mode.setdefault(r["column"], r["value"])
        seen[r["column"]].append(r["value"])
    levels = {}
    for c in columns:
        if c in encode.BINNED_LEVELS:
            levels[c] = encode.BINNED_LEVELS[c]
        elif c in spec.binary:
            levels[c] = sorted({"1" if v == spec.positive else "0" for v in seen[c]})
        else:
            levels[c] = sorted(seen[c])
    return mode, levels


def _repaired(
    df: DataFrame, spec: TableSpec, state: PrepState, dedup: bool, fill: Mapping[str, object], keep: Sequence[str] = (),
    rows: int = 0,
) -> DataFrame:
    out = clean.handle_missing(clean.drop_columns(df, spec), spec, state.strategy, fill)
    if dedup and keep:
        # Equal rows collapse to the one with the smallest kept values, the same one on every run.
        others = [c for c in out.columns if c not in keep]
        if rows:
            # Most rows differ, so combining them before the shuffle would only fill the memory of the tasks that read
            # large files. They go straight to the task of their hash, and there are enough tasks to hold them.
            out = out.withColumn("__row_hash", F.xxhash64(*others)).repartition(parts_for(df.sparkSession, rows), "__row_hash")
            others = ["__row_hash", *others]
        return out.groupBy(*others).agg(*[F.min(c).alias(c) for c in keep]).select(*[c for c in out.columns if c != "__row_hash"])
    return clean.remove_duplicates(out) if dedup else out


def fit(
    train: DataFrame, spec: TableSpec, strategy: str = "mean", scaling: str = "standard",
    encoding: str = "onehot", maxima: Mapping[str, float] | None = None, store_rows: bool = False,
) -> PrepState:
    """Learn imputation, encoding and scaling from the training rows alone.

    One job for categories, one for imputation numbers and one, after
    duplicates are removed, for the scaler. Nothing larger than the state
    reaches the driver. ``store_rows`` stores the distinct rows, each with its smallest id, as ``distinct`` of the
    state, so that their vectors don't need the duplicates removed again; ``train`` should be a stored table.
    """
    state = PrepState(strategy, scaling, encoding, maxima=dict(maxima or {}))
    plain = clean.drop_columns(train, spec)
    if encoding == "onehot":
        mode, state.levels = _learn_levels(plain, spec, strategy)
        numeric = [c for c in spec.numerical if c in train.columns]
        if strategy == "drop":
            state.fill = {}
        else:
            measure = clean.numeric_medians if strategy == "median" else clean.numeric_means
            state.fill = {**measure(plain, numeric), **mode}
    else:
        state.fill = clean.fit_fill_values(plain, spec, strategy)
    if store_rows and strategy != "drop":  # which would also drop rows for a null id
        kept = spec.with_(drop=tuple(c for c in spec.drop if c != spec.id_col))
        distinct = _repaired(train, kept, state, True, state.fill, (spec.id_col,), train.count())
        with compiled(train.sparkSession):
            state.distinct = materialize(distinct, "distinct-rows")
        clean_rows = state.distinct.drop(spec.id_col)
    else:
        clean_rows = _repaired(train, spec, state, True, state.fill)
    numeric = [c for c in spec.numerical if c in train.columns]
    derived = [c for c in NUMERIC_FEATURES if c in train.columns]
    if scaling == "robust":
        clean_rows = materialize(clean_rows, "fit-rows")
    state.scaler, state.feature_fill = scale.fit_scaler_and_means(clean_rows, numeric, scaling, derived)
    if encoding in ("label", "target"):
        coded = encode.encode_binary(clean_rows, spec)
        columns = encode.categorical_columns(coded.drop(spec.target), spec)
        codes = (
            encode.fit_label_codes(coded, columns) if encoding == "label"
            else encode.fit_target_means(coded, columns, F.col(spec.target))
        )
        state.codes = materialize(codes, "codes")
    plain_names = [c for c in train.columns if c not in (*spec.drop, spec.target, *state.levels)]
    state.feature_names = plain_names + [encode.onehot_name(c, v) for c, vs in state.levels.items() for v in vs]
    return state


def transform(
    df: DataFrame, spec: TableSpec, state: PrepState, include_target: bool = True,
    stats_from: str = "fit", dedup: bool = True, keep: Sequence[str] = (), within: Sequence[str] = (),
    rows: int = 0,
) -> DataFrame:
    """Apply a fitted state: drop, impute, deduplicate, encode, scale.

    Duplicates are removed after the id is gone, so subjects with equal
    features collapse. Training keeps one id per distinct row with ``keep``;
    scoring keeps every row with ``dedup=False``. Columns in ``within`` pass
    through and separate rows: equal rows collapse only inside them.``stats_from="self"`` takes imputation values and levels from
    ``df`` instead of the state. ``rows`` is how many rows ``df`` has, if known: with ``keep`` duplicates are then
    removed in tasks of bounded size.
    """
    fill, levels = state.fill, state.levels
    if stats_from == "self":
        bare = clean.drop_columns(df, spec)
        fill = clean.fit_fill_values(bare, spec, state.strategy)
        if state.encoding == "onehot":
            _, levels = _learn_levels(bare, spec, state.strategy)
    kept = tuple(c for c in spec.drop if c not in keep)
    repaired = _repaired(df, spec.with_(drop=kept), state, dedup, fill, keep, rows)
    coded = encode.encode_binary(repaired, spec)
    target = [F.col(spec.target)] if include_target and spec.target in coded.columns else []
    tail = coded.select("*", *[t.alias("__target") for t in target]).drop(spec.target)
    if state.encoding == "onehot":
        tail = encode.encode_onehot(tail, levels)
    elif state.codes is not None:
        columns = [c for c in encode.categorical_columns(tail, spec) if c not in (*keep, *within)]
        tail = encode.apply_codes(tail, state.codes, columns, "error" if state.encoding == "label" else "null")
    tail = scale.apply_scaler(tail, state.scaler)
    features = [c for c in tail.columns if c != "__target"]
    return tail.select(*[F.col(f"`{c}`") for c in features], *[F.col("__target").alias(spec.target) for _ in target])


@dataclass
class Prepared:
    """Result of :func:`run`: the three processed tables, the state and the validation report."""

    train: DataFrame
    test: DataFrame
    val: DataFrame
    state: PrepState
    spec: TableSpec
    report: DataFrame | None = None
    features: DataFrame | None = None

    def raw_parts(self, name: str) -> DataFrame:
        """One part with its id and derived features, before imputation and encoding."""
        return self.features.where(F.col("split") == name).drop("split")

    def frames(self) -> dict[str, DataFrame]:
        return {"train": self.train, "test": self.test, "val": self.val}

    def features_and_target(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        return {
            name: (df.drop(self.spec.target), df.select(self.spec.target)) for name, df in self.frames().items()
        }

    def all_rows(self) -> DataFrame:
        parts = [df.withColumn("split", F.lit(name)) for name, df in self.frames().items()]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])


def run(
    df: DataFrame, spec: TableSpec, validate: bool = True, engineer: bool = True,
    save_to: str | None = None, strategy: str = "mean", scaling: str = "standard",
    encoding: str = "onehot", parity: bool = False, seed: int = 42, store_rows: bool = False,
) -> Prepared:
    """Validate, derive features, split, fit on train and transform all three parts.

    Validation runs first and its report is stored; failed checks do not stop the run.
    The split rows are written once to the shared folder because fitting and
    three transformations read them; derived features are a map over them. ``parity=True`` takes the
    interaction maxima from the whole table and imputation values and levels
    from each part, instead of from the training rows. ``store_rows`` is that of :func:`fit`, for plans that go on to
    train.
    """
    report = materialize(validation_report(df, spec), "validation") if validate else None
    parts = materialize(stratified_split(df, spec.target, spec.id_col, seed=seed), "split-rows", ("split",))
    maxima = None
    if engineer:
        if spec.role("age", df.columns) and spec.role("size", df.columns):
            maxima = interaction_maxima(parts if parity else parts.where("split = 'train'"), spec)
        parts = engineer_features(parts, spec, maxima)

    def part(frame: DataFrame, name: str) -> DataFrame:
        return frame.where(F.col("split") == name).drop("split")

    state = fit(part(parts, "train"), spec, strategy, scaling, encoding, maxima, store_rows)
    if parity:
        done = {
            name: transform(part(parts, name), spec, state, stats_from="fit" if name == "train" else "self")
            for name in SPLITS
        }
    else:
        # One plan for all parts. The split is part of every row's identity, so a
        # filter on it reaches the stored folders through the duplicate removal.
        whole = transform(parts, spec, state, within=("split",))
        done = {name: part(whole, name) for name in SPLITS}
    result = Prepared(done["train"], done["test"], done["val"], state, spec, report, parts)
    if save_to:
        if parity:
            raise ValueError("parts with their own levels have no common schema to save under")
        spark = df.sparkSession
        write_splits(whole, f"{save_to}/splits")
        state.save(spark, f"{save_to}/state")
        stored = spark.read.schema(whole.schema).parquet(f"{save_to}/splits")
        for name in SPLITS:
            setattr(result, name, part(stored, name))
    return result
