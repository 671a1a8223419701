"""Plan building blocks that keep operators safe on skewed, very large inputs."""
