"""The operators: envelopes, winners, merges, repairs."""
