"""DataFrame to DataFrame steps, used by batch and streaming alike."""
