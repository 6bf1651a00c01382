from landfall.plans.layers import (
    TableRule,
    accepted,
    dedup_table,
    rejects,
    run_layer,
    run_pipeline,
    transform_source,
    transformed_table,
    type_table,
    typed_table,
)
from landfall.plans.marts import (
    fact_lines,
    line_revenue,
    orphans,
    revenue_by_nation_year,
    segment_month_report,
)
from landfall.plans.steps import Step, StepFailed, run_steps, steps_from_dir

__all__ = [
    "Step",
    "StepFailed",
    "TableRule",
    "accepted",
    "dedup_table",
    "fact_lines",
    "line_revenue",
    "orphans",
    "rejects",
    "revenue_by_nation_year",
    "run_layer",
    "run_pipeline",
    "run_steps",
    "segment_month_report",
    "steps_from_dir",
    "transform_source",
    "transformed_table",
    "type_table",
    "typed_table",
]
