"""DataFrame operators: profiles, bins, cleaning, encoding, tests, models, scoring."""
