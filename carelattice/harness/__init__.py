"""The registered queries over the given tables, their bindings and their SQL; not part of the engine."""
