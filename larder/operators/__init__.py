"""Table operators: functions from DataFrame to DataFrame, lazy unless their name says otherwise."""
