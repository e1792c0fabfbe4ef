"""Column expressions with the semantics of the contract."""
