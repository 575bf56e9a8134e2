"""Name parsing: departments, job kinds, report paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicspark.settings import DEPARTMENTS, OTHER_DEPARTMENT


def department(service_name, known=DEPARTMENTS) -> Column:
    """The part of a category before ``" - "`` if it is a known department, else ``Other``."""
    prefix = F.trim(F.element_at(F.split(service_name, " - "), 1))
    return F.coalesce(F.when(prefix.isin(*known), prefix), F.lit(OTHER_DEPARTMENT))


def job_kind(name, project: str) -> Column:
    """``<project>-<kind>-<stamp>`` or ``pipelines-<run>-<Step>-<suffix>``; else null."""
    name = F.col(name) if isinstance(name, str) else name
    own = f"{project}-"
    launched = F.nullif(
        F.regexp_replace(F.call_function("substring", name, F.lit(len(own) + 1)), r"-\d{8}-\d{6}$", ""), F.lit("")
    )
    parts = F.split(name, "-")
    step = F.when(
        F.size(parts) >= 4, F.concat(F.lit("pipeline-"), F.lower(F.element_at(parts, 3)))
    ).otherwise("pipeline")
    return F.when(name.startswith(own), launched).when(name.startswith("pipelines-"), step)


def report_value(report, path: str) -> Column:
    """A dotted path inside a JSON report, as a double."""
    return F.get_json_object(report, f"$.{path}").cast("double")


def contains_text(column, pattern: str) -> Column:
    """Case-insensitive literal containment; null counts as no."""
    return F.coalesce(F.contains(F.lower(column), F.lit(pattern.lower())), F.lit(False))
