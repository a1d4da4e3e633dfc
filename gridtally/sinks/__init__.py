"""Writers. Each can be rerun after a failure without doubling its rows."""
