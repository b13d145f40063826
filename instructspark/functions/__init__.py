"""Column expressions: text, predicates, prompts, validation, task types, rewards."""
