"""Column functions: text helpers, date reading, classification rules, citation readers, hashing."""
