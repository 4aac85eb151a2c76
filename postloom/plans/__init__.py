"""The tables of the post model, each a function of its inputs."""
