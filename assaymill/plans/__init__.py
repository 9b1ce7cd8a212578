"""End-to-end datasets: silver, gold, BI extracts, measures and analyses."""
