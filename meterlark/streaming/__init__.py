"""The same scorers and counts over unbounded inputs."""
