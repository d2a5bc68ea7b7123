"""End-to-end jobs and the mapping of the driver tables onto the job inputs."""
