"""The batch plans: clean, index, analyses, features, models, reports."""
