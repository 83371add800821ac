"""DataFrame to DataFrame operators: staging, rules, keys, upserts, dimensions, facts, audit."""
