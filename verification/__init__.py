"""Sample inputs in the engine's data model, the registered queries and their SQL oracles."""
