"""End-to-end plans: input derivations, the layered build, the triple store."""
