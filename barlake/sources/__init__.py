"""Landed vendor data to the common bar, calendar, fundamentals and instrument frames."""
