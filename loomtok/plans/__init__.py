"""Composed plans: the registered queries, their SQL oracles and the
end-to-end corpus -> vocabulary -> report run."""
