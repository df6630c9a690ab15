"""Record types, prompts, providers and the flow of the catalogue engine."""
