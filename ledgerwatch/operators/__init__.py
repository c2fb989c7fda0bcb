"""DataFrame operators: slicing, separation, scoring quality, drift, explanation, scorecards."""
