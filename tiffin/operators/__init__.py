"""Table operators: staging, dimension maintenance, facts, access rules."""
