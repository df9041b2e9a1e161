"""Loading in steps, with progress kept by Structured Streaming checkpoints."""
