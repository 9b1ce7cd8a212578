"""Column -> Column functions: text cleaning, numbers and money, dates."""
