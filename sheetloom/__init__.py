"""sheetloom: DataFrame operators for drawing schedules, sheet texts and their training-data clean-up."""
