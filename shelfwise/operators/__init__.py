"""Analytics operators: functions from DataFrame to DataFrame."""
