"""Named, ordered table steps with an audit of rows and nulls."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.functions.exprs import null_cells
from riskloom.session import discard, discard_path, sibling_session, stage
from riskloom.sources.readers import read_table

AUDIT_SCHEMA = (
    "step_no int, step string, rows_before bigint, rows_after bigint, rows_changed bigint, "
    "nulls_before bigint, nulls_after bigint, status string, error string"
)


@dataclass(frozen=True)
class Step:
    name: str
    function: Callable[..., DataFrame]
    options: dict = field(default_factory=dict)


class StepPlan:
    """A chain of `DataFrame -> DataFrame` steps.

    Row and null counts ride along with the data (one `Observation` per step
    boundary), so auditing adds no pass over it. The steps run on a staged copy of the
    input, or on a table on disk, in a sibling session: a session that has observed
    anything can no longer be shipped with the MLlib models that refer to it. The
    audit is complete when the result has been staged.
    """

    def __init__(self, name: str = "steps") -> None:
        self.name = name
        self.steps: list[Step] = []
        self.audit: list[tuple] = []
        self.scratch: list[DataFrame] = []  # staged by steps, deleted once the result is written

    def add_step(self, name: str, function: Callable[..., DataFrame], **options) -> StepPlan:
        self.steps.append(Step(name, function, options))
        return self

    def build(self, df: DataFrame) -> tuple[DataFrame, list[Observation]]:
        """The lazy chain and its boundary observations; a failing step is audited and raised."""
        current, mark = _watch(df)
        marks = [mark]
        for i, step in enumerate(self.steps):
            try:
                current, mark = _watch(current.transform(step.function, **step.options))
            except Exception as error:
                self._record(marks, failed=(i, str(error)))
                raise
            marks.append(mark)
        return current, marks

    def execute(self, df: DataFrame) -> DataFrame:
        """Run the steps on `df`; the result is a staged table of its session."""
        path = stage(df, "steps-in")
        result = self.execute_table(df.sparkSession, path, df.schema)
        discard_path(df.sparkSession, path)
        return result

    def execute_table(
        self, spark: SparkSession, path: str, schema: StructType | None = None
    ) -> DataFrame:
        """Run the steps on a table on disk."""
        self.audit = []
        own = sibling_session(spark)
        # Steps over many columns make methods beyond the 8 000 bytes that the JVM compiles: those go column by column.
        own.conf.set("spark.sql.codegen.hugeMethodLimit", 8000)
        planned, marks = self.build(read_table(own, path, schema))
        try:
            result = stage(planned, "steps-out")
        except Exception as error:
            gap = (None,) * 5
            self.audit = [(len(self.steps), "write", *gap, "failed", str(error))]
            raise
        self._record(marks)
        while self.scratch:
            discard(self.scratch.pop())
        return spark.read.schema(planned.schema).parquet(result)

    def _record(self, marks: Sequence[Observation], failed: tuple[int, str] | None = None) -> None:
        if failed is not None:
            i, error = failed
            done = [(n, s.name, None, None, None, None, None, "success", None)
                    for n, s in enumerate(self.steps[:i])]
            self.audit = [
                *done, (i, self.steps[i].name, None, None, None, None, None, "failed", error)
            ]
            return
        found = [m.get for m in marks]
        self.audit = []
        for i, step in enumerate(self.steps):
            before, after = found[i], found[i + 1]
            self.audit.append(
                (
                    i, step.name, before["n"], after["n"], after["n"] - before["n"],
                    before["nulls"], after["nulls"], "success", None,
                )
            )

    def report(self, spark) -> DataFrame:
        return spark.createDataFrame(self.audit, AUDIT_SCHEMA)


def _watch(df: DataFrame) -> tuple[DataFrame, Observation]:
    mark = Observation()
    nulls = F.coalesce(F.sum(null_cells(df.columns)), F.lit(0)).cast("bigint")
    return df.observe(mark, F.count(F.lit(1)).alias("n"), nulls.alias("nulls")), mark


def run_steps(
    df: DataFrame, steps: Sequence[tuple[str, Callable[..., DataFrame], dict]]
) -> tuple[DataFrame, DataFrame]:
    """Run (name, function, options) steps; the result and its audit table."""
    plan = StepPlan()
    for name, function, options in steps:
        plan.add_step(name, function, **options)
    result = plan.execute(df)
    return result, plan.report(df.sparkSession)
