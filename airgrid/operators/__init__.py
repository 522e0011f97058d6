"""DataFrame-in, DataFrame-out operators; all lazy unless a docstring says otherwise."""
