from rentmill.plans.business import RANKINGS, rank, rank_directly
from rentmill.plans.pipeline import run_pipeline
from rentmill.plans.staging import STAGES
from rentmill.plans.weekly import append_and_summarise, weekly_returned

__all__ = ["RANKINGS", "STAGES", "append_and_summarise", "rank", "rank_directly", "run_pipeline", "weekly_returned"]
