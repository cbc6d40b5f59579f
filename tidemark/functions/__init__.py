"""Column functions: calendar, hashing, scoring rules, ordered running totals, distribution tails."""
