"""The delay reports, their export, and the whole job."""
