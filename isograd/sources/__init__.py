"""Reading grids and result tables, writing them, and checking inputs."""
