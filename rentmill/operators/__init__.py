from rentmill.operators.counting import carry_counts, counted_rows, join_counts
from rentmill.operators.joins import join_through
from rentmill.operators.ranking import preview, rank_by_count
from rentmill.operators.views import isolated_session, passed_to, register_views, run_sql, session_like

__all__ = [
    "carry_counts", "counted_rows", "isolated_session", "join_counts", "join_through", "passed_to", "preview",
    "rank_by_count", "register_views", "run_sql", "session_like",
]
