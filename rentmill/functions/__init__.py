from rentmill.functions.dates import register_functions, week_start

__all__ = ["register_functions", "week_start"]
