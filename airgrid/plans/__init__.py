"""The user-level jobs, composed from operators; all lazy unless a docstring says otherwise."""
