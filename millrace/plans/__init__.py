"""The layer jobs, each as a batch plan and as a streaming job."""
